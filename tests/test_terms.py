"""Terms counted and turned into vectors by Arrow batches."""

import collections
import random

import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler

from ledgerlens.functions.text import add_terms
from ledgerlens.operators import encode
from ledgerlens.operators.terms import term_counter, vectoriser

ODD = ["", None, " ", "a", "Red CAR, red\tcar", "x1 y2äz3", "İstanbul Kelvin ab", "ab", "a b c", "café cafés", "aa" * 40, "aa aa aa"]


def texts(n=200):
    rnd = random.Random(3)
    return ODD + [" ".join(rnd.choice(["red", "car", "x", "über", "b2", "Bus-stop", ""]) for _ in range(rnd.randint(0, 12))) for _ in range(n)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def by_hand(spark, df):
    """(count, df) of every term from the terms of each row."""
    n, d = collections.Counter(), collections.Counter()
    for r in add_terms(df, "t").select("terms").collect():
        n.update(r["terms"])
        d.update(set(r["terms"]))
    return {t: (n[t], d[t]) for t in n}


def test_batches_count_what_rows_hold(spark):
    df = spark.createDataFrame([(t,) for t in texts()], "t string").repartition(3)
    got = {r["term"]: (r["count"], r["df"]) for r in encode.term_stats(df, "t").collect()}
    assert got == by_hand(spark, df)


@pytest.mark.parametrize("most", [1, 50, 1 << 20])
def test_pieces_of_any_size_add_up(most):
    rows = [t.lower() for t in texts() if t is not None]
    whole, parts = collections.Counter(), collections.Counter()
    for out, size in ((whole, 1 << 30), (parts, most)):
        for b in term_counter(2, size)(pa.RecordBatch.from_arrays([pa.array(rows[a:a + 50])], names=["t"]) for a in range(0, len(rows), 50)):
            for r in b.to_pylist():
                out.update({(r["term"], "n"): r["n"], (r["term"], "d"): r["d"]})
    assert parts == whole
    terms = ["car", "red", "red car"]
    x = pa.array(rows).slice(3)  # a slice has offsets of its own
    assert vectoriser(terms, [1.0, 2.0, 3.0], most=most)(x).equals(vectoriser(terms, [1.0, 2.0, 3.0])(x))


def test_terms_tasks_grow_with_the_text(spark, monkeypatch):
    monkeypatch.setattr(encode, "_TASK_BYTES", 100)
    df = spark.createDataFrame([("red car " * 50,)] * 40, "t string")
    p = plan(encode.term_stats(df, "t"))
    n = -(-40 * 400 // 100)
    assert "hashpartitioning(term" in p and f", {n})" in p
    assert p.index("HashAggregate") < p.index("Exchange") < p.index("MapInArrow")  # no map of a whole input task's terms
    assert "HashAggregate" not in p[p.index("Exchange"):]


def test_vectors_are_those_of_the_ml_stages(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "i int, t string").repartition(3)
    terms = sorted(by_hand(spark, df))[::2]
    idf = [1.0 + i / 7 for i in range(len(terms))]
    x = PipelineModel(stages=encode.tfidf_stages(terms, idf, "terms", "c")).transform(add_terms(df, "t"))
    both = encode.add_tfidf(x, "t", terms, idf, "v").select("c", "v").collect()
    assert len(both) == len(texts()) and all(r["c"] == r["v"] for r in both)
    assert any(r["v"].numNonzeros() > 2 for r in both)


def test_vectors_state_their_size(spark, tmp_path):
    spark.createDataFrame([("red car",)], "t string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("t string").parquet(f"{tmp_path}/in")
    x = encode.add_tfidf(stream, "t", ["car", "red"], [1.0, 1.0], "v")
    assert VectorAssembler(inputCols=["v"], outputCol="f").transform(x).isStreaming  # without a size it asks the first row


MIXED = ["Red CAR red Car", "\u0130STANBUL \u212aELVIN Stra\u00dfe \u00c5NGSTR\u00d6M \u017fEE", "\u0130\u0130 \u212a\u212a A\u0130 2\u212a", "x" * 40 + "Y", None]


def test_tasks_lower_the_case_themselves(spark):
    """``lower`` ran over every text before each of the two passes."""
    df = spark.createDataFrame([(t,) for t in MIXED + [t and t.title() for t in texts()]], "t string").repartition(3)
    stats, want = encode.term_stats(df, "t"), by_hand(spark, df)
    assert {r["term"]: (r["count"], r["df"]) for r in stats.collect()} == want
    terms = sorted(want)
    x = PipelineModel(stages=encode.tfidf_stages(terms, [1.0] * len(terms), "terms", "c")).transform(add_terms(df, "t"))
    assert all(r["c"] == r["v"] for r in encode.add_tfidf(x, "t", terms, [1.0] * len(terms), "v").select("c", "v").collect())
    assert "lower(" not in plan(stats) and "lower(" not in plan(encode.add_tfidf(df, "t", terms, [1.0] * len(terms), "v"))


def test_terms_too_many_for_one_number_are_counted_alike():
    rows = pa.RecordBatch.from_arrays([pa.array([t for t in texts() if t is not None])], names=["t"])

    def counts(**how):
        return sorted(tuple(r.values()) for b in term_counter(2, 1 << 30, **how)(iter([rows])) for r in b.to_pylist())

    assert counts(widest=1) == counts() != []

"""Plans and helpers that must not grow faster than their input (findings of round 3)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlens import registry_io, registry_models
from ledgerlens import fixtures as fx
from ledgerlens.functions import arrays, dates
from ledgerlens.operators.split import smallest, split_hash
from ledgerlens.plans.preprocess import FeaturePipeline
from ledgerlens.plans.score import predict_batch
from ledgerlens.plans.train import train_logistic
from ledgerlens.sources.writers import write_table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_vector_positions_parse_documents_once(spark):
    got = plan(E.queries()["b12_numeric_vector"](spark, SF))
    assert got.count("from_json") == 1 and "size(array(" not in got


def test_top_k_has_no_comparing_lambda(spark):
    df = spark.createDataFrame([(1, [0.2, 0.5, None, 0.5, float("nan")]), (2, []), (3, None), (4, [0.1])], "i int, a array<double>")
    got = df.select("i", arrays.top_k_per_row("a", 3).alias("t"))
    assert "array_sort" not in plan(got)
    old = F.slice(F.reverse(F.array_sort(F.transform("a", lambda x, i: F.struct(x.alias("prob"), i.alias("idx"))))), 1, 3)
    both = df.select(arrays.top_k_per_row("a", 3).cast("string").alias("x"), old.cast("string").alias("y"))
    assert all(r.x == r.y for r in both.collect())


def test_a_layout_is_tried_only_with_its_separator(spark):
    texts = ["1/2/2020", "31/1/2020", "2020-1-2", "1-2-2020", "31.1.2020", "1/2-2020", "1.2/2020", "13-13-2020", " 1/2/2020 ", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select(dates.parse_date("s").cast("string").alias("d"))
    assert plan(got).count("Contains(") + plan(got).count("contains(") >= 5
    assert [r.d for r in got.collect()] == ["2020-01-02", "2020-01-31", "2020-01-02", "2020-01-02", "2020-01-31", None, None, None,
                                            "2020-01-02", None, None]


@pytest.mark.parametrize("n", [1, 40, 500, 5000])
def test_smallest_hashes(spark, n):
    df = spark.range(2000).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("k"), (F.col("id") * 2).alias("v"))
    want = [r.h for r in df.select(split_hash("k", 7).alias("h")).orderBy("h").limit(n).collect()]
    got = smallest(df, "k", n, 7)
    assert got.columns == ["k", "v"]
    assert [r.h for r in got.select(split_hash("k", 7).alias("h")).collect()] == want


def test_a_classifier_needs_the_vectors_of_its_own_rows_only(spark, monkeypatch):
    monkeypatch.setattr(registry_models, "_FITTED", {})
    monkeypatch.setattr(registry_models, "FIT_ROWS", 20)
    monkeypatch.setattr(registry_models.bounded, "__defaults__", (20,))
    seen = []
    monkeypatch.setattr(registry_models, "_vectors", lambda m, rows, f=registry_models._vectors: seen.append(f(m, rows)) or seen[-1])
    assert registry_models.training(spark, SF).count() == 20
    assert [x.count() for x in seen] == [20] and not any(seen[0].select("is_val").toPandas()["is_val"])


def test_streams_are_checked_against_one_scoring(spark, tmp):
    lines = fx.invoice_lines(spark, SF).where(F.length("Inv_Id") < 12)
    model = FeaturePipeline(max_features=50).fit(lines)
    lr = train_logistic(model.transform(lines), max_iter=3)
    rows = fx.invoice_lines_nulls(spark, SF).drop("Product_Category").limit(40)
    write_table(rows, f"{tmp}/in", "csv")
    whole = predict_batch(registry_io.readers.scan_invoice_lines(spark, f"{tmp}/in", labelled=False), model, lr).localCheckpoint()
    ids = [r.Inv_Id for r in whole.select("Inv_Id").distinct().orderBy("Inv_Id").limit(3).collect()]
    wrong = F.when(F.col("Inv_Id") == ids[2], F.lit("CLASS-0")).otherwise(F.col("Predicted_Category"))
    other = whole.where(F.col("Inv_Id") != ids[0]).unionByName(whole.where(F.col("Inv_Id") == ids[1])).withColumn("Predicted_Category", wrong)
    both = registry_io._against_batch(spark, {"n_rows": whole, "n2": other}, f"{tmp}/in", model, lr)
    assert both._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    got = {r.Inv_Id: r for r in both.collect()}
    assert not got[ids[0]].same_as_batch and got[ids[0]].n2 == 0 and got[ids[1]].n2 == 2 * got[ids[1]].n_rows
    assert not got[ids[2]].same_as_batch and got[ids[2]].n_rows == got[ids[2]].n2
    assert all(r.same_as_batch and r.n_rows == r.n2 for i, r in got.items() if i not in ids)
    alone = registry_io._against_batch(spark, {"n_rows": whole}, f"{tmp}/in", model, lr)
    assert alone.columns == ["Inv_Id", "Vendor_Code", "GL_Code", "n_rows", "same_as_batch"]
    assert all(r.same_as_batch for r in alone.collect())

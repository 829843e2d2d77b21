"""Token files against the tokenizers library; mixing rates; sharding table."""

import math
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import mixing, queries, sharding, token_files
from ledgerlens.llm.common import shared_path

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_random_texts_match_the_library(library):
    with open(PATH, encoding="utf-8") as f:
        enc = token_files.WordEncoder(f.read())
    rnd = random.Random(3)
    parts = ["'", "s", "t", "re", " ", "  ", "\n", "\t", "\r\n", "　", "é", "É", "Σ", "ΑΣ", "İ", "A", "1", "²", "!", "#", "日", "'S",
             "'ll", " 's", "́", "E", "<|endoftext|>", "<|ENDOFTEXT|>", "x" * 50, "yz" * 40, "\x1c", "\x0b", "\x0c", ",", "!!", "ç", "K", "ᆨ", "가"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(4000)]
    for lo in range(0, len(texts), 7):  # slices with and without marks of special tokens
        ids, starts = enc.encode(pa.array([*texts[lo:lo + 7], None]))
        for i, t in enumerate(texts[lo:lo + 7]):
            assert library.encode(t, add_special_tokens=False).ids == ids[starts[i]:starts[i + 1]].tolist(), t
        assert starts[-1] == starts[-2] == len(ids)


def test_query_matches_the_library(spark, sf, library):
    rows = queries.op6_token_files(spark, sf).orderBy("doc_id").collect()
    src = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    at = 0
    for r, d in zip(rows, src, strict=True):
        ids = [*library.encode(d.text or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (
            d.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_files_order_lookup_and_edge_rows(spark, docs, library):
    path = shared_path(spark)
    token_files.write(docs.withColumn("ids", F.lit("clash")).withColumn("part", F.lit(1)), path, PATH, end_id=2)
    back = token_files.read(spark, path)
    assert set(back.columns) == {"doc_id", "start", "ids"}
    rows = sorted(back.collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids[0] is None and ids[1:] == sorted(ids[1:]) and len(ids) == docs.count()
    total = 0
    for r in rows:
        assert r.start == total
        total += len(r.ids)
    assert [r.ids for r in rows if r.doc_id in (2, 3, 4)] == [[2], [2], [2]]
    hit = token_files.lookup(spark, path, [5])
    assert "PushedFilters: [In(doc_id" in hit._jdf.queryExecution().executedPlan().toString() or "EqualTo(doc_id" in \
        hit._jdf.queryExecution().executedPlan().toString()
    assert [list(r.ids) for r in hit.collect()] == [[*library.encode("Füße über Straßen — 12 Äpfel!!  ok", add_special_tokens=False).ids, 2]]
    empty = shared_path(spark)
    token_files.write(docs.limit(0), empty, PATH, end_id=2)
    assert token_files.read(spark, empty).count() == 0




def test_rates_meet_targets_and_stay_nonnegative(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(n), [float(x) for x in rng.dirichlet([0.2, 0.2, 0.2])]) for i, n in enumerate(rng.integers(0, 500, 400))]
    post = spark.createDataFrame(rows, "_key long, tokens long, post array<double>")
    targets = lambda have: mixing.weighted_targets(have, [8.0, 1.0, 1.0])
    rates, have, want = mixing.fit_rates(post, targets, domains=3)
    got = rates.toPandas()
    assert (got.rate >= 0).all() and got.rate.min() == 0.0  # the bound is met
    p, t = np.array(got.post.tolist()), got.tokens.to_numpy()
    assert np.allclose((got.rate.to_numpy() * t) @ p, want, rtol=1e-4) and np.allclose(have, want, rtol=1e-5)
    kept, have, want = mixing.fit_rates(post, domains=3, least=1.0)
    assert kept.agg(F.min("rate")).first()[0] >= 1.0 and np.allclose(have, want, rtol=2e-2)


def full_least_squares(p, t, want, least):
    """Smallest norm of the gaps in share of the targets, by accelerated projected gradient with restarts."""
    r = y = np.ones(len(t))
    big, turn, before = np.linalg.eigvalsh((p * t[:, None]).T @ p).max(), 1.0, np.inf
    for _ in range(6000):
        new = np.maximum(least, y - p @ ((y * t) @ p - want) / big)
        now = np.linalg.norm((new * t) @ p - want)
        if now > before:
            y, turn, before = r, 1.0, np.inf
            continue
        nxt = (1 + math.sqrt(1 + 4 * turn * turn)) / 2
        r, y, turn, before = new, new + (turn - 1) / nxt * (new - r), nxt, now
    return np.linalg.norm((r * t) @ p - want) / sum(want)


@pytest.mark.parametrize("alpha", [[0.2] * 4, [0.05] * 16, [2.0, 0.5, 0.2, 0.1]])
def test_bounded_rates_are_the_full_least_squares_solution(spark, alpha):
    rng = np.random.default_rng(5)
    p, t = rng.dirichlet(alpha, 600), rng.integers(1, 500, 600)
    rows = [(i, int(n), [float(x) for x in v]) for i, (n, v) in enumerate(zip(t, p, strict=True))]
    post = spark.createDataFrame(rows, "_key long, tokens long, post array<double>").cache()
    rates, have, want = mixing.fit_rates(post, domains=len(alpha), least=1.0)
    got = rates.orderBy("_key").toPandas().rate.to_numpy()
    total = (got * t) @ p
    assert got.min() >= 1.0 and np.allclose(total, have, atol=1e-5 * sum(want))
    assert np.linalg.norm(total - want) / sum(want) <= full_least_squares(p, t, want, 1.0) + 1e-5


def test_mixing_of_edge_rows(spark, docs):
    labelled = docs.select("doc_id", F.col("lang").alias("domain"))
    rates, domains, have, _ = mixing.mix(docs, labelled)
    assert domains == ["de", "en", "ja"] and len(have) == 3
    rows = rates.collect()
    assert len(rows) == docs.select(mixing.row_key("doc_id", "text")).distinct().count()
    assert all(math.isclose(sum(r.post), 1.0) and r.rate >= 0 for r in rows)
    none, one, have, _ = mixing.mix(docs, labelled.limit(0))
    assert one == [mixing.OTHER] and {r.rate for r in none.collect()} == {1.0}
    assert mixing.mix(docs.limit(0), labelled)[0].count() == 0


def test_repeated_rows_have_the_words_of_one(spark):
    rows = [(i, f"one two three {'x ' * i}", "d1" if i % 2 else "d2") for i in range(30)]
    docs = spark.createDataFrame(rows + [rows[7]] * 4, "doc_id long, text string, domain string")
    once, twice = ({r._key: r for r in mixing.posteriors(
        d.select(mixing.row_key("doc_id", "text").alias("k"), "text"), *mixing.fit_domains(
            docs, docs, id_col="doc_id", text_col="text", domain_col="domain"), key_col="k", text_col="text").collect()}
        for d in (docs.distinct(), docs))
    assert {k: r.tokens for k, r in once.items()} == {k: r.tokens for k, r in twice.items()}
    assert all(np.allclose(once[k].post, twice[k].post) for k in once) and sorted(r.rows for r in twice.values())[-2:] == [1, 5]
    rates, _, have, _ = mixing.mix(docs, docs, least=1.0)
    total = sum(r.tokens * r.rows * r.rate for r in rates.collect())
    assert math.isclose(total, sum(have), rel_tol=1e-5)


def test_every_labelled_domain_is_kept(spark):
    rows = [(100 * d + i, f"word{d} " * (5 + i), "other" if d == 19 else f"d{d:02d}") for d in range(20) for i in range(20 - d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    rates, domains, have, want = mixing.mix(docs, docs, least=1.0)
    assert domains == sorted({r[2] for r in rows}) and len(have) == len(want) == 20
    assert all(len(r.post) == 20 and r.rate >= 1 for r in rates.collect())


def test_sources_meet_targets(spark):
    lang = {"x": "one two three", "y": "uno dos tres"}
    rows = [(i, f"{lang['xy'[i % 2]]} " * 20, "xy"[i % 2], "hot" if i < 140 else "cold" if i < 180 else None) for i in range(200)]
    rows.append((199, rows[199][1], "y", "cold"))  # the same document in two sources
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string, source string")
    rates, domains, have, want = mixing.mix(docs, docs, least=1.0)
    assert domains == ["x", "y"] and len(have) == len(want) == 5 and np.allclose(have, want, rtol=1e-4)
    cold, hot, null = want[2:]
    assert math.isclose(cold / hot, (41 / 140) ** 0.7, rel_tol=0.02) and math.isclose(null / hot, (20 / 140) ** 0.7, rel_tol=0.02)
    rate = {r._key: r.rate for r in rates.collect()}
    got = docs.select("source", mixing.row_key("doc_id", "text").alias("k")).collect()
    assert math.isclose(sum(60 * rate[r.k] for r in got if r.source == "hot"), hot, rel_tol=1e-3)


def test_applied_rates_repeat_rows(spark, docs):
    rates = docs.select(mixing.row_key("doc_id", "text").alias("_key")).distinct().withColumn("rate", F.lit(2.0))
    clash = docs.withColumn("_key", F.lit("a")).withColumn("_n", F.lit(7)).withColumn("rate", F.lit(0))
    out = mixing.apply_rates(clash, rates)
    assert out.columns == clash.columns and out.count() == 2 * docs.count()
    assert mixing.apply_rates(docs, rates.withColumn("rate", F.lit(0.0))).count() == 0


def test_query_keeps_every_document_and_targets(spark, sf):
    got = queries.op8_mixing(spark, sf).toPandas()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert (got.n_copies >= 1).all()
    lang = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id").lang
    cols = [c for c in got.columns if c.startswith("p_")]
    best = got[cols].idxmax(axis=1).str[2:]
    assert (best.to_numpy() == lang.loc[got.doc_id].to_numpy()).mean() >= 0.9  # 79 labelled documents to learn from
    assert queries.op8_mixing(spark, sf)._jdf.queryExecution().executedPlan().toString().count("Python") == 0


def test_table_is_even_and_stable():
    names = [f"s{i}" for i in range(7)]
    a = sharding.lookup_table(names, 1009)
    counts = np.bincount(a, minlength=7)
    assert counts.max() - counts.min() <= 1
    b = sharding.lookup_table(names[:-1], 1009)
    moved = sum(names[x] != names[y] for x, y in zip(a, b, strict=True) if x != 6)
    assert moved < 0.35 * 1009
    assert sharding.lookup_table(list(reversed(names)), 1009) == a
    for bad in ((names, 1000), ([], 11), (["a", "a"], 11), (names, 5)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_placement_of_edge_rows_and_written_shards(spark, docs):
    clash = docs.withColumn("slot", F.lit("x")).withColumn("shard", F.lit("own"))
    got = sharding.place(clash, ["a", "b", "c"], size=101).collect()
    assert len(got) == docs.count() and {r.shard for r in got} <= {"a", "b", "c"}
    assert len({r.shard for r in got if r.doc_id == 1}) == 1
    path = shared_path(spark)
    assert sharding.write_shards(clash, ["a", "b", "c"], path, size=101, tasks_per_shard=2) == "shard_"
    back = spark.read.parquet(path)
    assert {r.shard for r in back.collect()} == {"own"}
    assert sorted((r.doc_id or -1, r.shard_) for r in back.collect()) == sorted((r.doc_id or -1, r.shard) for r in got)
    assert sharding.place(docs.limit(0), ["a"], size=11).count() == 0


def test_placement_does_not_shuffle(spark, sf):
    p = queries.op10_sharding(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p and "Exchange hashpartitioning" not in p and "SortMergeJoin" not in p

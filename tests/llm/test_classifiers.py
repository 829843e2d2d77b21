"""Quality and toxicity classifiers: parts against brute force, held-out accuracy, edge rows."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import quality, queries, toxicity

SF1 = "/root/testdata/sf0.01"


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    node, trans, lines = rng.normal(size=9) * 2, rng.normal(size=(2, 2)), np.array([1, 5, 3])
    p, pair = quality.marginals(node, trans, lines)
    want, pairs, at = [], [], 0
    for n in lines:
        total, z, two = np.zeros(n), 0.0, np.zeros((n - 1, 2, 2))
        for s in itertools.product((0, 1), repeat=int(n)):
            v = np.exp(sum(node[at + i] for i in range(n) if s[i]) + sum(trans[s[i], s[i + 1]] for i in range(n - 1)))
            z += v
            total += v * np.array(s)
            for i in range(n - 1):
                two[i, s[i], s[i + 1]] += v
        want += (total / z).tolist()
        pairs += (two / z).tolist()
        at += n
    assert np.allclose(p, want) and np.allclose(pair, np.array(pairs))


def test_line_features_mark_repeats_and_kinds():
    own, length, lines = quality.line_features(["aa aa aa aa\naa aa aa aa\nThe dog.", "", "A!! B!!"])
    assert lines.tolist() == [3, 1, 1] and length.tolist() == [11, 11, 8, 0, 7]
    col = lambda share: share * len(quality.LEVELS)
    assert own[0, col(10)] == 1 and own[2, col(10)] == 0  # adjacent equal words
    assert own[1, col(9)] == 1 and own[0, col(9)] == 0  # the second copy of a line
    assert own[4, col(6)] == 1 and own[3].sum() == 0  # exclamation marks; an empty line has no features


def test_long_chain_is_stable():
    node = np.tile([30.0, -30.0, 0.1], 5000)
    p, _ = quality.marginals(node, np.array([[2.0, -2.0], [-2.0, 2.0]]), np.array([len(node)]))
    assert np.isfinite(p).all() and p[0] > 0.9


def _held_out(spark, rows, col, at):
    labels = spark.read.parquet(f"{SF1}/labels.parquet").select("doc_id", F.col(col).alias("y"))
    return rows.join(labels, "doc_id").where("held_out").select("y", "score", "predicted").toPandas()


def test_quality_on_held_out_rows(spark):
    rows = queries.op2_quality_classifier(spark, SF1)
    assert rows.count() == spark.read.parquet(f"{SF1}/documents.parquet").count()
    h = _held_out(spark, rows, "quality", 0.3)
    assert (h.y == h.predicted).mean() >= 0.95
    assert h.score[h.y == 1].min() > 0.3


def test_toxicity_on_held_out_rows(spark):
    rows = queries.op7_toxicity(spark, SF1)
    h = _held_out(spark, rows, "toxic", 0.7)
    # 33 toxic rows to learn from, in four languages: some can't be known; no clean row may go.
    assert (h.y == h.predicted).mean() >= 0.93
    assert (h.predicted[h.y == 0] == 0).all()


def test_toxicity_learns_with_more_rows(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", F.col("toxic").alias("y"))
    h = queries.op7_toxicity(spark, d).join(labels, "doc_id").where("held_out").select("y", "predicted").toPandas()
    assert (h.y == h.predicted).mean() >= 0.98


def test_hashed_grams_are_the_distinct_ones():
    h = toxicity.Hasher()
    text = "abcabcabc"
    grams = [t[i:i + n] for n in (3, 4, 5) for t in [f" {text} "] for i in range(len(t) - n + 1)]
    found, value = h.distinct(text)
    assert len(found) == len(set(found.tolist())) == len(set(grams)) and len(h.grams(text)) == len(grams)
    rate = sorted(grams.count(g) * toxicity.PER / len(text) for g in set(grams))
    assert np.allclose(np.sort(value), [r / (1 + r) for r in rate])
    assert set(h.grams("ABC  def").tolist()) == set(h.grams("abc\tdef").tolist())
    assert len(h.grams("")) == 0 and len(h.grams("a")) == 1


def test_edge_rows_and_missing_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    one = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (None, 0, 0), (2, None, None), (3, 7, 7)],
                                "doc_id long, toxic int, quality int")
    both = spark.createDataFrame([(1, 1, 1), (5, 0, 0), (2, 0, 1), (3, 0, 0), (6, 1, 1)],
                                 "doc_id long, toxic int, quality int")
    for labels in (none, one, both):
        t = toxicity.fit(docs, labels)
        q = quality.fit(docs, labels)
        for df in (toxicity.score(docs, t), quality.score(docs, q)):
            s = [r.score for r in df.collect()]
            assert len(s) == docs.count() and all(0.0 <= x <= 1.0 for x in s)
        assert toxicity.score(docs.limit(0), t).count() == 0 and quality.score(docs.limit(0), q).count() == 0
    again = {r.score for r in toxicity.score(docs.where("doc_id = 1"), t).collect()}
    assert len(again) == 1  # repeated rows score alike


def test_reject_keeps_columns_and_rows(spark, docs):
    model = toxicity.ToxicityModel(np.full(1 << toxicity.BITS, -1, np.int32), np.zeros(0), -5.0)
    clash = docs.withColumn("score", F.lit(2.0)).withColumn("_text", F.lit("z"))
    kept = toxicity.reject(clash, model, 0.7)
    assert kept.schema == clash.schema and kept.count() == clash.count()
    assert toxicity.reject(clash, model, 0.0).count() == 0


def test_mixed_chains_hold_a_block_of_the_other_class():
    lines, y, w = np.array([3, 1, 30, 2]), np.array([1.0, 0.0, 0.0, 1.0]), np.array([1.0, 2.0, 3.0, 4.0])
    at, n, label, weight = quality.mixed_chains(lines, y, w)
    of = np.repeat(np.arange(4), lines)
    assert n[:4].tolist() == lines.tolist() and at[:36].tolist() == list(range(36)) and weight.tolist() == [*w, *w]
    assert len(at) == len(label) == n.sum() and (label == y[of[at]]).all()
    begin = np.cumsum(n) - n
    for i in range(4):
        chain = at[begin[4 + i]:begin[4 + i] + n[4 + i]]
        own = chain[of[chain] == i]
        put = chain[of[chain] != i]
        assert (np.diff(own) == 1).all() and len(own) == lines[i]  # the text itself, whole and in order
        assert 1 <= len(put) <= quality.BLOCK_LINES and (np.diff(put) == 1).all() and set(y[of[put]]) == {1.0 - y[i]}
        where = np.flatnonzero(of[chain] != i)
        assert (np.diff(where) == 1).all()


def test_bad_lines_inside_good_documents_are_found(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    model = queries.fit_quality(docs, labels.select("doc_id", "quality"))
    held = docs.join(labels, "doc_id").where(queries.id_remainder("doc_id", 5) == 0).orderBy("doc_id").select("text", "quality").collect()
    good = [r.text.split("\n") for r in held if r.quality == 1 and r.text.count("\n") >= 6]
    bad = [r.text.split("\n")[:4] for r in held if r.quality == 0 and r.text.count("\n") >= 3]
    assert len(good) > 100 and len(bad) > 50
    hits = np.zeros((2, 2), int)
    for i, g in enumerate(good):
        b, k = bad[i % len(bad)], len(g) // 2
        p, _, _ = quality.label_lines(model, ["\n".join(g[:k] + b + g[k:])])
        truth = np.array([1] * k + [0] * len(b) + [1] * (len(g) - k))
        np.add.at(hits, (truth, (p >= 0.5).astype(int)), 1)
    assert hits[0, 0] / hits[0].sum() >= 0.85 and hits[1, 1] / hits[1].sum() >= 0.98


def test_fit_takes_bounded_lines_of_a_text(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_LINES", 5)
    seen = []
    real = quality.fit_sample
    monkeypatch.setattr(quality, "fit_sample", lambda own, length, lines, y, w: seen.append(lines) or real(own, length, lines, y, w))
    docs = spark.createDataFrame([(1, "a b c.\n" * 40), (2, "!!! |||\n" * 3), (3, "x")], "doc_id long, text string")
    quality.fit(docs, spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int"))
    assert sorted(seen[0].tolist()) == [1, 4, 5]


def test_margin_is_the_highest_of_text_and_windows(monkeypatch):
    monkeypatch.setattr(toxicity, "WINDOW", 40)
    rng = np.random.default_rng(4)
    h = toxicity.Hasher()
    slot = np.full(1 << toxicity.BITS, -1, np.int32)
    for size in (0, 3, 70, 81, 400):
        text = "".join(rng.choice(list("abcd ef"), size)).strip()
        seen = np.unique(h.grams(text))
        slot[:] = -1
        slot[seen[::2]] = np.arange(len(seen[::2]))
        weights = rng.normal(size=max(1, len(seen[::2])))
        at, value = h.features(text, slot)
        best = float((weights[at] * value).sum())
        if len(text) > 80:
            cp = f" {' '.join(text.split())} "
            halves = {}
            for n in toxicity.ORDERS:
                for i in range(len(cp) - n + 1):
                    s = slot[h_one(h, cp[i:i + n], n)]
                    if s >= 0:
                        for w in (i // 20, i // 20 - 1):
                            if w >= 0:
                                halves.setdefault(w, {}).setdefault(int(s), 0)
                                halves[w][int(s)] += 1
            for counts in halves.values():
                rate = {s: c * toxicity.PER / 40 for s, c in counts.items()}
                best = max(best, sum(weights[s] * r / (1 + r) for s, r in rate.items()))
        assert np.isclose(h.margin(text, slot, weights), best)


def h_one(hasher, gram, n):
    """Bucket of one n-gram of plain lower-case text."""
    code = np.uint32(ord(gram[0]))
    with np.errstate(over="ignore"):
        for c in gram[1:]:
            code = code * toxicity._BASE + np.uint32(ord(c))
        return int(((code ^ (code >> np.uint32(15))) * toxicity._MIX + np.uint32(n * 7919)) >> np.uint32(32 - toxicity.BITS))


def test_toxic_passage_inside_a_long_clean_text(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    model = queries.fit_toxicity(docs, labels.select("doc_id", "toxic"))
    held = docs.join(labels, "doc_id").where(queries.id_remainder("doc_id", 3) == 1).orderBy("doc_id").select("text", "toxic").collect()
    clean = [r.text for r in held if r.toxic == 0 and len(r.text) > 20_000]
    toxic = [r.text[:1500] for r in held if r.toxic == 1][:40]
    assert (toxicity.score_texts(model, clean) < queries.TOXIC_AT).all()
    inside = [c[:len(c) // 2] + "\n" + t + "\n" + c[len(c) // 2:] for c, t in zip(clean * 40, toxic)]
    assert (toxicity.score_texts(model, inside) >= queries.TOXIC_AT).mean() >= 0.5


def test_null_ids_count_as_the_empty_text(spark):
    df = spark.createDataFrame([(None,), (7,)], "doc_id long")
    got = [r[0] for r in df.select(queries.id_remainder("doc_id", 3)).collect()]
    assert got[0] == 0 and got[1] is not None

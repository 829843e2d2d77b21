"""Branches of the fused model (I4) and the fitted text branch (K4, K5)."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ledgerlens.operators.encode import vector_entries
from ledgerlens.plans.preprocess import TextBranch
from ledgerlens.plans.score import score_with
from ledgerlens.plans.train import forward, join_branches, train_fused


@pytest.fixture(scope="module")
def rows(spark):
    """Three parts of a class, each known to one branch only; some keys lack an embedding."""
    rng = np.random.default_rng(2)
    data = []
    for i in range(240):
        t, n, e = (int(b) for b in rng.integers(0, 2, 3))
        text = " ".join(rng.choice(["red", "old", "big"], 3)) + (" ring" if t else " bolt")
        data.append((i, text, [1000.0 * n + float(rng.normal(0, 50)), 5.0], [float((2 * e - 1) + rng.normal(0, 0.2)), 0.5, -0.5], t, n, e))
    return spark.createDataFrame(data, "id long, words string, nums array<double>, emb array<float>, t int, n int, e int").withColumn(
        "label", (F.col("t") * 4 + F.col("n") * 2 + F.col("e")).cast("double"))


@pytest.fixture(scope="module")
def branch(rows):
    return TextBranch.fit(rows, "words", "vec", max_features=50)


@pytest.fixture(scope="module")
def joined(rows, branch):
    emb = rows.where("id % 10 <> 7").select("id", "emb")
    return join_branches(branch(rows.drop("emb")), "id", emb)


def accuracy(fused, df, by):
    got = fused.transform(df.where("emb IS NOT NULL")).select(F.col("prediction").cast("int").alias("p"), *by).collect()
    return np.mean([[(r.p >> 2 & 1) == r.t, (r.p >> 1 & 1) == r.n, (r.p & 1) == r.e] for r in got], axis=0)


def fit(df, **use):
    return train_fused(df, text_col="vec", numeric_col="nums", embedding_col="emb", hidden=(16,), max_iter=60, n_classes=8,
                       scale_numeric=True, **use)


def test_three_branches_each_add_what_they_know(joined):
    whole = fit(joined)
    assert whole.inputs == ["vec", "nums", "emb"] and whole.widths[1:] == [2, 3]
    assert (accuracy(whole, joined, "tne") > 0.95).all()
    for off, at in (("use_text", 0), ("use_numeric", 1), ("use_embedding", 2)):
        part = fit(joined, **{off: False})
        got = accuracy(part, joined, "tne")
        assert len(part.inputs) == 2 and got[at] < 0.75 and all(got[i] > 0.9 for i in range(3) if i != at)
    for only in range(3):
        part = fit(joined, **{u: False for i, u in enumerate(("use_text", "use_numeric", "use_embedding")) if i != only})
        assert len(part.inputs) == 1 and accuracy(part, joined, "tne")[only] > 0.95


def test_scores_equal_a_by_hand_assembly(joined, branch):
    fused = fit(joined)
    layers = list(fused.model.getLayers())
    predict = forward(fused.model.weights.toArray().tolist(), layers)()
    mean, std = map(np.array, fused.scaling["nums"])
    own = {r.id: np.array(r.p) for r in fused.transform(joined).select("id", vector_to_array("probability").alias("p")).collect()}
    texts = {r.id: r for r in joined.select("id", "words", "nums", "emb").collect()}
    assert any(r.emb is None for r in texts.values())
    for i, r in texts.items():
        toks = r.words.split()
        tf = Counter(toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])])
        x = np.array([tf[t] * w for t, w in zip(branch.vocabulary, branch.idf)])
        x = x / (np.sqrt((x * x).sum()) or 1)
        full = np.concatenate([x, (np.array(r.nums) - mean) / std, r.emb if r.emb is not None else np.zeros(3)])
        assert np.allclose(predict(full[None, :])[0], own[i], atol=1e-5)
    x = fused.assemble(joined).select("id", vector_to_array("_fused").alias("x"))
    again = score_with(x, forward(fused.model.weights.toArray().tolist(), layers), "x", n_outputs=8, out="q", input_dim=layers[0])
    assert all(np.allclose(r.q, own[r.id], atol=1e-5) for r in again.collect())


def test_absent_branches_are_errors(joined):
    with pytest.raises(ValueError, match="no column"):
        train_fused(joined, text_col="vec", use_embedding=True)
    with pytest.raises(ValueError, match="no column other"):
        train_fused(joined, text_col="vec", embedding_col="other")
    with pytest.raises(ValueError, match="at least one"):
        train_fused(joined, text_col="vec", use_text=False)
    with pytest.raises(ValueError, match="null in every row"):
        train_fused(joined.withColumn("none", F.lit(None).cast("array<float>")), text_col="vec", embedding_col="none")
    fused = fit(joined)
    with pytest.raises(ValueError, match="lacks: emb"):
        fused.transform(joined.drop("emb"))


def test_text_branch_weights_unknown_terms_and_round_trip(spark, branch, tmp):
    df = spark.createDataFrame([(1, "Red RING, red!"), (2, "never seen"), (3, None), (4, "")], "id int, words string")
    loaded = TextBranch.load(spark, _saved(spark, branch, tmp))
    assert loaded == branch
    got = {}
    for r in vector_entries(loaded(df), "vec", ["id"]).collect():
        got.setdefault(r.id, {})[branch.vocabulary[r.idx]] = r.weight
    assert set(got) == {1}
    tf = {t: c for t, c in {"red": 2, "ring": 1, "red ring": 1, "ring red": 1}.items() if t in branch.vocabulary}
    raw = {t: c * branch.idf[branch.vocabulary.index(t)] for t, c in tf.items()}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert got[1] == pytest.approx({t: v / norm for t, v in raw.items()})


def _saved(spark, branch, tmp):
    branch.save(spark, f"{tmp}/branch")
    return f"{tmp}/branch"


def test_batched_scores_are_those_of_the_perceptron(joined):
    """Sparse and dense vectors mixed in one batch, in batches of several matrices, and no row at all."""
    from ledgerlens.plans import train

    fused = fit(joined)
    x = fused.assemble(joined.unionByName(joined.where("emb IS NULL")))
    dense = array_to_vector(vector_to_array("_fused"))
    x = x.withColumn("_fused", F.when(F.col("id") % 3 == 0, dense).otherwise(F.col("_fused"))).coalesce(1)
    cols = ["id", *[vector_to_array(c).alias(c) for c in ("rawPrediction", "probability")], "prediction"]
    want = sorted(map(tuple, fused.model.transform(x).select(*cols).collect()))
    cells, train.BATCH_CELLS = train.BATCH_CELLS, 7 * fused.model.getLayers()[0]
    try:
        got = sorted(map(tuple, fused.classify(x).select(*cols).collect()))
    finally:
        train.BATCH_CELLS = cells
    assert len(got) == len(want) > 240
    for a, b in zip(got, want, strict=True):
        assert a[0] == b[0] and a[3] == b[3] and np.allclose(a[1], b[1]) and np.allclose(a[2], b[2])
    assert fused.classify(x.where("id < 0")).count() == 0
    plan = fused.transform(joined)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan  # batches, not a row at a time

"""Classifiers are fitted on every training row, not on a sample."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ledgerlens import registry, registry_models
from ledgerlens.plans import train
from ledgerlens.plans.preprocess import FeaturePipeline, fit_split


def lines(spark, n):
    i = F.col("id").cast("int")
    return spark.range(n).select(
        F.concat(F.lit("I-"), i.cast("string")).alias("Inv_Id"), F.concat(F.lit("V-"), (i % 7).cast("string")).alias("Vendor_Code"),
        F.concat(F.lit("GL-"), (i % 4).cast("string")).alias("GL_Code"), (i % 50).cast("double").alias("Inv_Amt"),
        F.concat(F.lit("part "), (i % 30).cast("string")).alias("Item_Description"),
        F.concat(F.lit("CLASS-"), (i % 4).cast("string")).alias("Product_Category"))


def test_line_classifiers_train_on_all_lines_not_held_out(spark, monkeypatch):
    n = 6000  # the former bound was 4,000 training rows
    model, split = fit_split(lines(spark, n), FeaturePipeline(max_features=40), 0.2, 42)
    monkeypatch.setattr(registry_models, "_FITTED", {})
    monkeypatch.setattr(registry_models, "parted", lambda spark, d: (model, split, model.class_dict))
    got = registry_models.training(spark, "made")
    want = split.where(~F.col("is_val"))
    assert got.count() == want.count() == n * 4 // 5
    assert got.select("Inv_Id").exceptAll(want.select("Inv_Id")).isEmpty()


def test_fused_models_train_on_all_documents_not_held_out(spark, monkeypatch):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit(0.0).alias("label"),
                                    (F.col("id") % 5 == 0).alias("is_val"), F.array(F.lit(1.0)).alias("embedding"))
    seen = []

    def stop(df, **_):
        seen.append(df.count())
        raise KeyError("seen")
    monkeypatch.setattr(registry_models, "_FITTED", {})
    monkeypatch.setattr(registry_models, "_doc_branches", lambda spark, d: (rows, None))
    monkeypatch.setattr(registry_models, "_three_branches", lambda spark, d: (rows, None))
    monkeypatch.setattr(registry_models.train, "train_fused", stop)
    for name in ("i4_train_fused", "i4_three_branches"):
        with pytest.raises(KeyError):
            registry.QUERIES[name](spark, "made")
    assert seen == [2400, 2400]  # the former bound was 1,000


def test_steps_go_back_from_values_that_are_no_numbers():
    def value(x):
        with np.errstate(all="ignore"):
            return float(np.sum(x - np.log(x))), 1 - 1 / x
    assert np.allclose(train._lbfgs(value, np.array([10.0, 0.01]), 200, tol=1e-12), 1, atol=1e-3)


def test_packed_rows_give_the_gradient_of_the_loss(spark):
    """Sparse and dense vectors, several blocks and steps, against differences of the loss."""
    layers, rng = [5, 3, 4], np.random.default_rng(1)
    dense = rng.normal(size=(20, 5)) * (rng.random((20, 5)) < 0.6)
    vec = [Vectors.dense(x) if i % 3 == 0 else Vectors.sparse(5, {int(j): float(x[j]) for j in np.flatnonzero(x)}) for i, x in enumerate(dense)]
    df = spark.createDataFrame([(v, float(i % 4)) for i, v in enumerate(vec)], ["_fused", "_label"])
    w = rng.normal(size=6 * 3 + 4 * 4)

    def loss(w):
        a, b, c, d = w[:15].reshape(5, 3), w[15:18], w[18:30].reshape(3, 4), w[30:]
        z = (1 / (1 + np.exp(-(dense @ a + b)))) @ c + d
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(20), np.arange(20) % 4]).sum())
    rows = df.select(F.unwrap_udt(F.col("_fused")).alias("v"), "_label").coalesce(2)
    sent = spark.sparkContext.broadcast(w)
    blocks = rows.mapInArrow(train._blocks(5, 4), "ends binary, idx binary, val binary, label binary")
    got = blocks.mapInArrow(train._gradient(sent, layers), "loss double, n long, g binary").collect()
    g = sum(np.frombuffer(r["g"], np.float32).astype(float) for r in got)
    near = [(loss(w + h) - loss(w - h)) / 2e-5 for h in np.eye(len(w)) * 1e-5]
    assert sum(r["n"] for r in got) == 20 and abs(sum(r["loss"] for r in got) - loss(w)) < 1e-4 and np.allclose(g, near, atol=1e-4)


@pytest.mark.parametrize("label", [None, float("nan"), -1.0, 2.0, 0.5])
def test_labels_that_are_no_class_are_errors(spark, label):
    df = spark.createDataFrame([([1.0], 0.0), ([2.0], label)], "v array<double>, label double")
    with pytest.raises(Exception, match="labels must be whole numbers"):
        train.train_fused(df, numeric_col="v", hidden=(2,), max_iter=2, n_classes=2)

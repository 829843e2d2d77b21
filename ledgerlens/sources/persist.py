"""Persistence of fitted state.

Fitted transforms and models are saved with Spark's own writers (distributed
where the model is large, e.g. forests); small metadata goes into a one-row
JSON table next to them.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LogisticRegressionModel, MultilayerPerceptronClassificationModel, RandomForestClassificationModel,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.preprocess import FeaturePipelineModel, NotFittedError

_MODEL_TYPES = {
    "LogisticRegressionModel": LogisticRegressionModel,
    "RandomForestClassificationModel": RandomForestClassificationModel,
    "MultilayerPerceptronClassificationModel": MultilayerPerceptronClassificationModel,
    "PipelineModel": PipelineModel,
}


def save_pipeline(model: FeaturePipelineModel | None, path: str) -> None:
    """A10: saving before fitting is an error."""
    if model is None:
        raise NotFittedError("the preprocessing pipeline must be fitted before it is saved")
    model.save(path)


def load_pipeline(spark: SparkSession, path: str) -> FeaturePipelineModel:
    """A10."""
    return FeaturePipelineModel.load(spark, path)


def save_model(spark: SparkSession, model, path: str, name: str, score: float, results: DataFrame | None = None) -> None:
    """The best model with its name, score and all results."""
    if model is None:
        raise ValueError("no trained model to save")
    model.write().overwrite().save(f"{path}/model")
    meta = {"name": name, "score": float(score), "type": type(model).__name__, "has_results": results is not None}
    if results is not None:
        results.coalesce(1).write.mode("overwrite").parquet(f"{path}/results")  # one row per model
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_model(spark: SparkSession, path: str):
    """(model, name, score, results or None)."""
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    model = _MODEL_TYPES[meta["type"]].load(f"{path}/model")
    results = spark.read.parquet(f"{path}/results") if meta["has_results"] else None
    return model, meta["name"], meta["score"], results


def write_label_mapping(class_dict: DataFrame, path: str) -> None:
    """Index -> label as JSON lines."""
    class_dict.select(F.col("idx").cast("int").alias("idx"), F.col("value").alias("label")).write.mode(
        "overwrite").json(path)


def read_label_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(idx int, value) back from JSON lines (keys restored to int)."""
    return spark.read.schema("idx int, label string").json(path).select("idx", F.col("label").alias("value"))

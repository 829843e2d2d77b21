"""Scoring (K1, K2, K4-K6): whole tables through one plan; no per-row driver work.

Probabilities leave the model as an ML vector; ``vector_to_array`` turns them
into an array column so confidence and top-3 are built-in array expressions.
Class indices are decoded through the fitted class dictionary (broadcast:
one row per class).
"""

from __future__ import annotations

from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import top_k_per_row
from ..functions.docs import feature_table, numeric_vector
from ..plans.features import text_to_features
from .preprocess import FeaturePipelineModel, fill_defaults


def _decode_array(pairs, class_map):
    """Map (idx, prob) structs to (label, prob) with a map column (label lookup without a join)."""
    return F.transform(pairs, lambda p: F.struct(F.coalesce(F.element_at(class_map, p["idx"]),
                                                            F.concat(F.lit("CLASS-"), p["idx"].cast("string")))
                                                 .alias("label"), p["prob"].alias("prob")))


def class_map(class_dict: DataFrame | None):
    """A map column idx -> label from the class dictionary (one row per class; a scalar subquery)."""
    if class_dict is None:
        return F.create_map().cast("map<int,string>")
    return class_dict.agg(F.map_from_entries(F.collect_list(F.struct(F.col("idx").cast("int"), "value")))).scalar()


def scored(df: DataFrame, classifier, class_dict: DataFrame | None, k: int = 3,
           keep_probabilities: bool = False) -> DataFrame:
    """Apply a fitted classifier: Predicted_Category, Confidence and the k best (label, prob)."""
    out = classifier.transform(df)
    probs = vector_to_array("probability")
    # The map is a scalar subquery; it becomes a column so the lambdas below can refer to it.
    out = out.withColumn("_p", probs).withColumn("_cmap", class_map(class_dict))
    cmap = F.col("_cmap")
    pred_idx = F.col("prediction").cast("int")
    out = (out.withColumn("Predicted_Category", F.coalesce(F.element_at(cmap, pred_idx),
                                                           F.concat(F.lit("CLASS-"), pred_idx.cast("string"))))
              .withColumn("Confidence", F.element_at("_p", pred_idx + 1))
              .withColumn("Top_Predictions", _decode_array(top_k_per_row("_p", k), cmap)))
    drop = ["rawPrediction", "probability", "prediction", "_p", "_cmap"]
    if keep_probabilities:
        out = out.withColumn("probabilities", F.col("_p"))
    return out.drop(*drop)


def predict_batch(df: DataFrame, features: FeaturePipelineModel, classifier) -> DataFrame:
    """K1: fill nulls, transform (no fit), predict; all input columns + Predicted_Category + Confidence."""
    cols = df.columns
    x = features.transform(fill_defaults(df))
    out = scored(x, classifier, features.class_dict)
    return out.select(*cols, "Predicted_Category", "Confidence")


def predict_top3(df: DataFrame, features: FeaturePipelineModel, classifier) -> DataFrame:
    """K2: as K1 plus the three best (label, prob) per row, over the whole table."""
    cols = df.columns
    x = features.transform(fill_defaults(df))
    return scored(x, classifier, features.class_dict).select(*cols, "Predicted_Category", "Confidence",
                                                             "Top_Predictions")


def predict_from_json(df: DataFrame, fused, text_model=None, class_dict: DataFrame | None = None,
                      json_column: str = "json_data") -> DataFrame:
    """K4: JSON -> features (C5) -> numeric vector (+ text vector) -> fused model -> class and confidence."""
    f = feature_table(df, json_column, keep=("file_name",))
    f = f.withColumn("numeric_features", numeric_vector(f))
    if text_model is not None:
        f = text_model(f)
    return _score_fused(f, fused, class_dict)


def _score_fused(df: DataFrame, fused, class_dict):
    return scored(df, fused, class_dict)


def predict_from_text(df: DataFrame, fused, class_dict: DataFrame | None = None, text_col: str = "text",
                      keep=("file_name",), return_document: bool = False, text_model=None) -> DataFrame:
    """K5: text -> document (D6) -> features (C4) -> vectors -> class, confidence, top 3; one chained plan."""
    f = text_to_features(df, text_col, keep=keep)
    f = f.withColumn("numeric_features", numeric_vector(f))
    if text_model is not None:
        f = text_model(f)
    out = _score_fused(f, fused, class_dict)
    if return_document:
        out = out.withColumn("json_data", F.to_json("_doc"))
    return out.drop("_doc")


def score_with(df: DataFrame, make_predict_fn, input_col: str, n_outputs: int | None = None,
               batch_size: int = 1024, out: str = "scores", input_dim: int | None = None) -> DataFrame:
    """K6: run the user's own batch model over a fixed-width array column in Arrow batches.

    ``make_predict_fn()`` is called once per Python worker and returns
    ``predict(np.ndarray[batch, d]) -> np.ndarray[batch] or [batch, k]``.
    ``input_dim`` (d) is read from one row when not given.
    """
    if input_dim is None:
        input_dim = int(df.select(F.size(input_col)).first()[0])
    rtype = T.ArrayType(T.FloatType()) if n_outputs else T.DoubleType()
    udf = predict_batch_udf(make_predict_fn, return_type=rtype, batch_size=batch_size,
                            input_tensor_shapes=[[input_dim]])
    x = df.withColumn("_in", F.col(input_col).cast("array<float>"))
    return x.withColumn(out, udf("_in")).drop("_in")

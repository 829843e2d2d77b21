"""Evaluation (J1-J6) and model selection (I6) as aggregates over prediction tables.

Per-class counts come from one aggregation: every row contributes a "true"
record for its true label and a "predicted" record for its predicted label,
so labels seen in either column are covered without a full outer join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def accuracy(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """One row (accuracy)."""
    return df.agg(F.avg((F.col(y_true) == F.col(y_pred)).cast("double")).alias("accuracy"))


def per_class(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """(label, tp, support, predicted, precision, recall, f1); zero division -> 0."""
    hit = (F.col(y_true) == F.col(y_pred)).cast("long")
    recs = df.select(F.explode(F.array(
        F.struct(F.col(y_true).cast("string").alias("label"), F.lit(1).cast("long").alias("t"),
                 F.lit(0).cast("long").alias("p"), hit.alias("tp")),
        F.struct(F.col(y_pred).cast("string").alias("label"), F.lit(0).cast("long").alias("t"),
                 F.lit(1).cast("long").alias("p"), F.lit(0).cast("long").alias("tp")),
    )).alias("r")).select("r.*")
    c = recs.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("t").alias("support"),
                                  F.sum("p").alias("predicted"))
    tp, sup, pred = F.col("tp").cast("double"), F.col("support"), F.col("predicted")
    return c.select(
        "label", "tp", "support", "predicted",
        F.when(pred > 0, tp / pred).otherwise(F.lit(0.0)).alias("precision"),
        F.when(sup > 0, tp / sup).otherwise(F.lit(0.0)).alias("recall"),
        F.when(sup + pred > 0, 2.0 * tp / (sup + pred)).otherwise(F.lit(0.0)).alias("f1"),
    )


def f1_scores(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """One row (f1_macro, f1_weighted) over labels seen in either column."""
    pc = per_class(df, y_true, y_pred)
    return pc.agg(
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
    )


def classification_report(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """(label, precision, recall, f1, support) per class plus 'accuracy', 'macro avg', 'weighted avg' rows.

    All rows come from one per-class table: accuracy is sum(tp) / sum(support).
    The summary rows are one aggregate over it, turned into three rows.
    """
    pc = per_class(df, y_true, y_pred)
    names = ("precision", "recall", "f1")
    classes = pc.select("label", *names, "support")
    s = F.sum("support")
    weighted = [(F.sum(F.col(n) * F.col("support")) / s).alias(f"w_{n}") for n in names]
    one = pc.agg(s.alias("support"), (F.sum("tp") / s).alias("acc"), *[F.avg(n).alias(f"m_{n}") for n in names], *weighted)
    rows = F.array(*[F.struct(F.lit(label).alias("label"), *[F.col(src).alias(n) for src, n in zip(cols, names)], F.col("support"))
                     for label, cols in (("accuracy", ["acc"] * 3), ("macro avg", [f"m_{n}" for n in names]),
                                         ("weighted avg", [f"w_{n}" for n in names]))])
    return classes.unionByName(one.select(F.explode(rows).alias("r")).select("r.*"))


def confusion_matrix(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Long form (y_true, y_pred, n)."""
    return df.groupBy(F.col(y_true).alias("y_true"), F.col(y_pred).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n"))


def class_labels(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", limit: int = 1000) -> list[str]:
    """All labels of both columns in order; more than ``limit`` (columns of a table for display) is an error."""
    both = df.select(F.explode(F.array(F.col(y_true).cast("string"), F.col(y_pred).cast("string"))).alias("label"))
    rows = both.where("label IS NOT NULL").distinct().orderBy("label").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} classes: use the long form of the confusion matrix")
    return [r["label"] for r in rows]


def confusion_pivot(df: DataFrame, labels: list | None = None, y_true: str = "y_true",
                    y_pred: str = "y_pred") -> DataFrame:
    """J5 for display: one row per true label, one column per predicted label (all labels by default)."""
    labels = labels or class_labels(df, y_true, y_pred)
    return confusion_matrix(df, y_true, y_pred).groupBy("y_true").pivot("y_pred", labels).sum("n").fillna(0)


def scores_of_counts(counts: dict[tuple, int]) -> tuple[float, float]:
    """(accuracy, weighted F1) from collected confusion counts {(true, predicted): n} (classes squared at most)."""
    total = sum(counts.values())
    labels = {x for pair in counts for x in pair}
    weighted = 0.0
    for c in labels:
        support = sum(n for (t, _), n in counts.items() if t == c)
        predicted = sum(n for (_, p), n in counts.items() if p == c)
        weighted += support * (2.0 * counts.get((c, c), 0) / (support + predicted))
    return sum(n for (t, p), n in counts.items() if t == p) / max(total, 1), weighted / max(total, 1)


def log_loss(df: DataFrame, prob_col: str, label_idx: str, eps: float = 1e-15) -> DataFrame:
    """Mean over rows of -ln(p[true class]), p clipped to [eps, 1 - eps]."""
    p = F.element_at(F.col(prob_col), F.col(label_idx).cast("int") + 1).cast("double")
    p = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    return df.agg(F.avg(-F.log(p)).alias("log_loss"))


def model_summary(name: str, order: int, df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred",
                  params: dict | None = None) -> DataFrame:
    """J4 row for one model: (model, train_order, accuracy, f1_weighted, f1_macro, params)."""
    f1 = f1_scores(df, y_true, y_pred)
    p = ", ".join(f"{k}={v}" for k, v in sorted((params or {}).items()))
    return accuracy(df, y_true, y_pred).select(
        F.lit(name).alias("model"), F.lit(order).alias("train_order"), "accuracy",
        f1.select("f1_weighted").scalar().alias("f1_weighted"), f1.select("f1_macro").scalar().alias("f1_macro"),
        F.lit(p).alias("params"))


def compare_models(rows: list[DataFrame]) -> DataFrame:
    """One row per model (union of one-row frames)."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def select_best(results: DataFrame, metric: str = "f1_weighted") -> DataFrame:
    """The model with the highest metric; on ties the earlier trained wins; the metric must exceed 0.

    No model above 0 is an error. The table has one row per model; it is computed once.
    """
    results = cut_lineage(results)
    w = Window.orderBy(F.desc(metric), F.asc("train_order"))
    best = results.where(F.col(metric) > 0).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    if best.isEmpty():
        raise ValueError(f"no model has a {metric} above 0")
    return best

"""Mergeable column profiles (F3, F5, F8): distinct-value and quantile sketches that are stored and united.

One aggregate over a table gives a row for each column (and part, e.g. a day): counts, moments, a HyperLogLog sketch and,
for numbers, a KLL quantile sketch. Rows of parts written at different times are united without reading the data again.
A sketch has a bounded size whatever the number of rows, so any number of parts fits a plain aggregation. The exact paths stay
in ``profile``. NaN counts as null. A part whose column is all null has zero counts and null statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K = 12  # 4,096 HyperLogLog slots
KLL_K = 400


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a united distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def rank_error(k: int = KLL_K) -> float:
    """Normalised rank error of a quantile, at 99 % confidence (fixed values of the KLL sketch)."""
    return 2.296 / k ** 0.9723


def column_sketches(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = (), lg_k: int = LG_K,
                    k: int = KLL_K) -> DataFrame:
    """One row for each part (``by``) and column: (*by, column_name, n, n_null, mean, m2, min, max, distinct, quantiles).

    All columns come from one aggregation over one scan. Any type of column may be counted: its 64-bit hash enters the sketch.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in (cols or df.columns) if c not in by]
    aggs: list[Column] = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        number = isinstance(types[c], T.NumericType)
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            x = F.when(~F.isnan(x), x)
        v = x.cast("double") if number else F.lit(None).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.sum(x.isNull().cast("long")).alias(f"z{i}"),
                 F.hll_sketch_agg(F.when(x.isNotNull(), F.xxhash64(x)), lg_k).alias(f"h{i}"),
                 F.avg(v).alias(f"a{i}"), (F.var_pop(v) * F.count(v)).alias(f"v{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        if number:
            aggs.append(F.kll_sketch_agg_double(v, k).alias(f"q{i}"))
    row = df.groupBy(*[F.col(f"`{b}`") for b in by]).agg(*aggs)
    parts = [F.struct(
        F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.coalesce(f"z{i}", F.lit(0)).alias("n_null"),
        F.col(f"a{i}").alias("mean"), F.col(f"v{i}").alias("m2"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"),
        F.col(f"h{i}").alias("distinct"),
        F.when(F.col(f"n{i}") > 0, F.col(f"q{i}") if f"q{i}" in row.columns else F.lit(None).cast("binary")).alias("quantiles"))
        for i, c in enumerate(cols)]
    return row.select(*[F.col(f"`{b}`") for b in by], F.explode(F.array(*parts)).alias("_s")).select(
        *[F.col(f"`{b}`") for b in by], "_s.*")


def unite(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of several parts as one for each column (and ``by``); the same columns as ``column_sketches``."""
    n = F.sum("n")
    mean = F.sum(F.col("n") * F.col("mean")) / n
    m2 = F.sum("m2") + F.sum(F.col("n") * F.col("mean") * F.col("mean")) - n * mean * mean
    return sketches.groupBy(*by, "column_name").agg(
        n.alias("n"), F.sum("n_null").alias("n_null"), mean.alias("mean"), F.greatest(m2, F.lit(0.0)).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.hll_union_agg("distinct").alias("distinct"),
        F.when(F.count("quantiles") > 0, F.kll_merge_agg_double("quantiles")).alias("quantiles"))


def n_unique_of(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, column_name, n_unique) as the sketches estimate it."""
    return sketches.select(*by, "column_name", F.hll_sketch_estimate("distinct").alias("n_unique"))


def quantiles_of(sketches: DataFrame, ps: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(*by, column_name, p, value) for every number column with a value; a value's rank is p within ``rank_error``."""
    at = F.array(*[F.lit(float(p)) for p in ps])
    held = sketches.where("quantiles IS NOT NULL")
    return held.select(*by, "column_name", F.explode(F.arrays_zip(
        at.alias("p"), F.kll_sketch_get_quantile_double("quantiles", at).alias("value"))).alias("_q")).select(
            *by, "column_name", "_q.p", "_q.value")


def describe_of(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """F5 of every number column: (*by, column_name, count, mean, std, min, q25, q50, q75, max)."""
    q = F.kll_sketch_get_quantile_double("quantiles", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    held = sketches.where("quantiles IS NOT NULL").withColumn("_q", q)
    std = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return held.select(*by, "column_name", F.col("n").alias("count"), "mean", std.alias("std"), "min", F.col("_q")[0].alias("q25"),
                       F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"), "max")

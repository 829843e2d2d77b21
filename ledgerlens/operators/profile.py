"""Profiling aggregates (F1-F13) and top-k.

Every profile is an aggregate over the whole table: partial aggregation runs
map-side, so only (group, partial state) rows cross the shuffle. Results are
DataFrames; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import general_category
from .ranking import running_total


def shape(df: DataFrame) -> DataFrame:
    """one row (n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_cols"))


def _unpivot(row: DataFrame, names, value: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return row.selectExpr(f"stack({len(names)}, {pairs}) as (column_name, {value})")


def null_counts(df: DataFrame, only_nonzero: bool = False) -> DataFrame:
    """(column_name, n_null) for every column, in one pass."""
    row = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    out = _unpivot(row, df.columns, "n_null")
    return out.where(F.col("n_null") > 0) if only_nonzero else out


def n_unique(df: DataFrame, cols=None, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """(column_name, n_unique) distinct non-null values; ``approx`` uses HyperLogLog++ (no distinct shuffle)."""
    cols = list(cols or df.columns)
    if approx:
        row = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in cols])
        return _unpivot(row, cols, "n_unique")
    # One distinct count per column, each over that column alone: counting several at once would
    # multiply every row by the number of columns before the shuffle.
    parts = [df.select(c).agg(F.countDistinct(c).alias("n_unique")).select(F.lit(c).alias("column_name"), "n_unique")
             for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """(value, count) per non-null value, count descending then value ascending; first n."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    ordered = counts.orderBy(F.desc("count"), F.asc("value"))
    return ordered.limit(n) if n else ordered


def exact_quantiles(data: DataFrame, col: str, ps) -> DataFrame:
    """One row with ``q``: exact quantiles by linear interpolation, without a one-task sort or value map.

    Values are counted, dealt out by range with a running total of their counts,
    and only the (at most two) values around each wanted rank are kept.
    """
    ps = list(ps)
    counted = data.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("x")).agg(
        F.count(F.lit(1)).alias("n"))
    ranked = running_total(counted, "x", "n")
    total = ranked.agg(F.sum("n")).scalar()
    vals = []
    for p in ps:
        pos = (total - 1) * F.lit(float(p))
        at = [F.max(F.when((F.col("before") <= r) & (r < F.col("before") + F.col("n")), F.col("x")))
              for r in (F.floor(pos), F.ceil(pos))]
        vals += [at[0], at[1], F.max(pos - F.floor(pos))]
    flat = ranked.agg(*[v.alias(f"v{i}") for i, v in enumerate(vals)])
    return flat.select(F.array(*[F.col(f"v{3 * i}") + (F.col(f"v{3 * i + 1}") - F.col(f"v{3 * i}")) * F.col(f"v{3 * i + 2}")
                                 for i in range(len(ps))]).alias("q"))


def _quantiles(data: DataFrame, col: str, ps, exact: bool, accuracy: int) -> DataFrame:
    """One row with ``q``. Not exact: the bounded-memory sketch (rank error about 1 / accuracy)."""
    if exact:
        return exact_quantiles(data, col, ps)
    return data.agg(F.percentile_approx(F.col(col).cast("double"), list(ps), accuracy).cast("array<double>").alias("q"))


def describe(df: DataFrame, col: str, exact: bool = True, accuracy: int = 100_000) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 %, max of one numeric column.

    ``exact`` quartiles interpolate linearly (as the reference) from distributed
    running counts; ``exact=False`` uses ``percentile_approx`` (one pass).
    """
    x = F.col(col).cast("double")
    q = _quantiles(df, col, (0.25, 0.5, 0.75), exact, accuracy).scalar()
    agg = df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                 F.max(x).alias("max")).withColumn("_q", q)
    return agg.select("count", "mean", "std", "min", F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"),
                      F.col("_q")[2].alias("q75"), "max")


def column_info(df: DataFrame) -> DataFrame:
    """(column_name, dtype, non_null) for every column."""
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    counts = _unpivot(row, df.columns, "non_null")
    types = df.sparkSession.createDataFrame(list(df.dtypes), "column_name string, dtype string")
    return counts.join(F.broadcast(types), "column_name").select("column_name", "dtype", "non_null")


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """equal-width counts between min and max, every bin (empty ones too): (bin, lo, hi, count).

    Bin of x = floor((x - min) * (bins / (max - min))) + 1, the maximum falling in the last bin.
    min and max are scalar subqueries, so there is no join to attach them.
    """
    data = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    lo = data.agg(F.min("x")).scalar()
    hi = data.agg(F.max("x")).scalar()
    scale = F.lit(float(bins)) / (hi - lo)
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((F.col("x") - lo) * scale).cast("int") + 1, F.lit(bins)))
    counted = data.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = data.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).select(
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "lo", "hi")
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (all_bins.join(counted, "bin", "left")
            .select("bin",
                    (F.col("lo") + (F.col("bin") - 1) * width).alias("lo"),
                    (F.col("lo") + F.col("bin") * width).alias("hi"),
                    F.coalesce("count", F.lit(0).cast("long")).alias("count")))


def box_stats(df: DataFrame, col: str, exact: bool = True, accuracy: int = 100_000,
              quartiles: DataFrame | None = None) -> DataFrame:
    """F8: quartiles, IQR, whiskers (furthest points within 1.5 IQR of the box) and outlier count; one row.

    The three quartiles come from one aggregate; that array enters the second
    aggregate as a single scalar subquery (fences for the whiskers). ``quartiles``, one row of
    ``sketches.describe_of``, stands in for that aggregate where stored sketches already hold them.
    """
    data = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    q = (_quantiles(data, "x", (0.25, 0.5, 0.75), exact, accuracy) if quartiles is None
         else quartiles.select(F.array("q25", "q50", "q75").alias("q"))).scalar()
    q1, q3 = q[0], q[2]
    lo_f, hi_f = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = (F.col("x") >= lo_f) & (F.col("x") <= hi_f)
    w = data.agg(
        F.min(F.when(inside, F.col("x"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("x"))).alias("upper_whisker"),
        F.count(F.when(~inside, F.lit(1))).alias("n_outliers"),
    )
    return w.select(q1.alias("q1"), q[1].alias("median"), q3.alias("q3"), "lower_whisker", "upper_whisker",
                    "n_outliers", (q3 - q1).alias("iqr"))


def examples_per_group(df: DataFrame, cat: str, k: int, order_by: str, top: int | None = None,
                       text_col: str | None = None) -> DataFrame:
    """the first k rows (by ``order_by``) of each category, over the ``top`` largest or all categories.

    Output: category, n (rows in the category), rn (1..k), the order key and ``text_col``.
    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before the
    shuffle, so at most k rows per category and map task are exchanged.
    """
    counts = df.groupBy(F.col(cat).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    if top:
        counts = counts.orderBy(F.desc("n"), F.asc("category")).limit(top)
    w = Window.partitionBy(cat).orderBy(order_by)
    keep = [order_by] + ([text_col] if text_col else [])
    firsts = df.select(cat, *keep).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    firsts = firsts.withColumnRenamed(cat, "category")
    return firsts.join(F.broadcast(counts) if top else counts, "category").select("category", "n", "rn", *keep)


def word_frequency(df: DataFrame, col: str, n: int | None = 30) -> DataFrame:
    """lower, keep [a-z whitespace], split, count; top n by count then word. Nulls are skipped."""
    letters = F.regexp_replace(F.lower(F.col(col)), r"[^a-z]+", " ")
    # explode_outer: a plain explode would have the words split twice (a filter on their number is inferred).
    words = df.where(F.col(col).isNotNull()).select(F.explode_outer(F.split(F.trim(letters), " ")).alias("word"))
    counts = words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    ordered = counts.orderBy(F.desc("count"), F.asc("word"))
    return ordered.limit(n) if n else ordered


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """count per class with the smallest count and the number of classes under 2 rows."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()  # over the small per-class table only
    return counts.select("label", "n", F.min("n").over(w).alias("min_count"),
                         F.sum((F.col("n") < 2).cast("long")).over(w).alias("n_classes_lt2"))


def head(df: DataFrame, n: int, order_by) -> DataFrame:
    """first n rows in a given order (an order must be given: tables have none)."""
    return df.orderBy(*([order_by] if isinstance(order_by, str) else order_by)).limit(n)


def bar_data(df: DataFrame, label: str, text: str) -> dict[str, DataFrame]:
    """the aggregates behind the reference's three bar charts."""
    return {
        "top_categories": value_counts(df, label, 20),
        "top_words": word_frequency(df, text, 20),
        "general_categories": value_counts(df.select(general_category(F.col(text)).alias("general_category")),
                                           "general_category"),
    }


def top_k(df: DataFrame, col: str, k: int, tie=None) -> DataFrame:
    """K largest values of ``col`` (descending; ties by ``tie`` ascending). Spark plans TakeOrderedAndProject."""
    order = [F.desc(col)] + ([F.asc(t) for t in ([tie] if isinstance(tie, str) else tie)] if tie else [])
    return df.orderBy(*order).limit(k)

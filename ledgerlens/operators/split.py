"""Train/validation splits (H1, H2), reproducible and independent of partitioning.

Membership comes from md5(seed | key): a class's smallest hashes go to
validation. Only the hash at the boundary has to be found: rows are counted by
(class, hash prefix), the prefix that holds the boundary is ranked, and every row
is then compared with its class's boundary in a map-side join. No payload column
is shuffled and no class is sorted as a whole.

Every row is kept: null classes form a class of their own, a null key hashes like
a fixed text. Rows that share a key share their side of the split, so a boundary
that falls on a repeated key takes all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

PREFIX_DIGITS = 4  # hex digits counted: 65,536 buckets a class, whatever its size
# Boundary tables (one row per class, under 200 bytes each) are broadcast up to this many bytes.
BROADCAST_BYTES = 64 << 20
_ROW_BYTES = 200


def split_hash(key: str, seed: int = 42) -> Column:
    """md5 of seed and key; a null key counts as the text 'null'."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))


def _boundaries(h: DataFrame, counts: DataFrame, n_val, k: int = 1) -> DataFrame:
    """(_g, _cut): the largest hash that goes to validation in each of the ``k`` classes of ``h`` (_g, _h)."""
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_g")  # at most 65,536 rows a class
    c = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    c = c.withColumn("_want", n_val(F.sum("_n").over(whole)) - F.col("_before"))
    at = c.where((F.col("_want") > 0) & (F.col("_want") <= F.col("_n"))).select("_g", "_p", "_want")  # at most one a class
    at = F.broadcast(at) if k * _ROW_BYTES <= BROADCAST_BYTES else at
    rows = h.withColumn("_p", F.substring("_h", 1, PREFIX_DIGITS)).join(
        at.select(F.col("_g").alias("_g2"), F.col("_p").alias("_p2"), "_want"),
        F.col("_g").eqNullSafe(F.col("_g2")) & (F.col("_p") == F.col("_p2")))
    nth = F.row_number().over(Window.partitionBy("_g").orderBy("_h"))
    return rows.withColumn("_r", nth).where(F.col("_r") == F.col("_want")).select("_g", F.col("_h").alias("_cut"))


def _counts(h: DataFrame) -> DataFrame:
    return cut_lineage(h.groupBy("_g", F.substring("_h", 1, PREFIX_DIGITS).alias("_p"))
                       .agg(F.count(F.lit(1)).alias("_n")))


def _plain(df: DataFrame, key: str, seed: int, out: str, h: DataFrame, counts: DataFrame, n_val) -> DataFrame:
    """One class: the boundary is a single value."""
    cut = _boundaries(h, counts, n_val).first()
    side = F.lit(False) if cut is None else split_hash(key, seed) <= F.lit(cut["_cut"])
    return df.withColumn(out, side)


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42,
                     out: str = "is_val") -> DataFrame:
    """H1: per class, the round(test_size * n_class) rows with the smallest hash go to validation.

    When some class has fewer than 2 rows the split is plain (unstratified):
    ceil(test_size * n) rows overall. Class totals may differ by a row or two
    from a library that redistributes rounding remainders to hit an exact total.
    """
    h = df.select(F.col(label).alias("_g"), split_hash(key, seed).alias("_h"))
    counts = _counts(h)
    per_class = counts.groupBy("_g").agg(F.sum("_n").alias("n"))
    st = per_class.agg(F.min("n").alias("lo"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    if st["lo"] is not None and st["lo"] >= 2:
        # One row a class, kept: every use of the split would find the boundaries again.
        cuts = cut_lineage(_boundaries(h, counts, lambda n: F.round(F.lit(test_size) * n), st["k"])).withColumnRenamed("_g", "_g2")
        cuts = F.broadcast(cuts) if st["k"] * _ROW_BYTES <= BROADCAST_BYTES else cuts
        joined = df.join(cuts, F.col(label).eqNullSafe(F.col("_g2")), "left")
        side = F.coalesce(split_hash(key, seed) <= F.col("_cut"), F.lit(False))
        return joined.withColumn(out, side).drop("_g2", "_cut")
    one = h.select(F.lit(0).alias("_g"), "_h")
    return _plain(df, key, seed, out, one, _counts(one), lambda n: F.ceil(F.lit(test_size) * n))


def random_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42, out: str = "is_val") -> DataFrame:
    """H2: floor(test_size * n) rows with the smallest hash go to validation, unstratified."""
    h = df.select(F.lit(0).alias("_g"), split_hash(key, seed).alias("_h"))
    return _plain(df, key, seed, out, h, _counts(h), lambda n: F.floor(F.lit(test_size) * n))


def smallest(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The ``n`` rows with the smallest hashes of the key, in that order.

    Rows are counted by hash prefix first, and only those up to the prefix that holds the n-th are sorted: a plain sort
    with a limit takes n whole rows from each task to one.
    """
    prefix = F.substring(split_hash(key, seed), 1, PREFIX_DIGITS)
    counts = df.groupBy(prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    so_far = F.sum("_n").over(Window.orderBy("_p"))  # at most 65,536 rows
    at = counts.withColumn("_c", so_far).where(F.col("_c") >= n).agg(F.min("_p")).first()[0]
    rows = df if at is None else df.where(prefix <= at)
    return rows.withColumn("_h", split_hash(key, seed)).orderBy("_h").limit(n).drop("_h")

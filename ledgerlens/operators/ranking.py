"""Exact ranks without funnelling a group (or the whole table) into one task.

``row_number().over(Window.partitionBy(g).orderBy(o))`` sends every row of a
group to one task, and an unpartitioned window sends the whole table to one.
``row_number_within`` range-partitions on (group, order), numbers rows per task
and adds per-(task, group) offsets. Partition ids depend on sampling, so the
tagged rows are checkpointed (reliable, shared folder) before the offsets are
joined back. ``running_total`` does the same for a cumulative sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id = (partition id << 33) + row position


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    conf = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return max(1, int(conf))


def _offsets(counts: DataFrame, group_cols, order_col: str, n_col: str) -> DataFrame:
    """Rows of the same group in earlier segments (a window over the small count table)."""
    w = Window.partitionBy(*group_cols).orderBy(order_col) if group_cols else Window.orderBy(order_col)
    prev = F.sum(n_col).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn("_off", F.coalesce(prev, F.lit(0)))


def row_number_within(df: DataFrame, group_cols, order_cols, out: str = "rank",
                      partitions: int | None = None, groups_bounded: bool = True) -> DataFrame:
    """Add ``out`` = 0-based position of each row within its group, ordered by ``order_cols``.

    ``order_cols`` must make the order total (append a unique key). The tagged
    rows are checkpointed once, so both uses below see the same partition ids.
    """
    group_cols = list(group_cols)
    keys = group_cols + list(order_cols)
    n = _num_partitions(df, partitions)
    ranked = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    tagged = ranked.withColumn("_mid", F.monotonically_increasing_id())
    tagged = cut_lineage(tagged.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS)))
    seg_keys = ["_pid"] + group_cols
    segs = tagged.groupBy(*seg_keys).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # Segments per partition are contiguous in range order: at most partitions + groups rows.
    segs = _offsets(segs, group_cols, "_pid", "_n").select(*seg_keys, "_first", "_off")
    segs = F.broadcast(segs) if groups_bounded else segs
    joined = tagged.join(segs, on=seg_keys, how="inner")
    return joined.withColumn(out, F.col("_mid") - F.col("_first") + F.col("_off")).drop(
        "_mid", "_pid", "_first", "_off")


def running_total(df: DataFrame, order_col: str, value_col: str, out: str = "before") -> DataFrame:
    """Add ``out`` = sum of ``value_col`` over the rows before each row in the order of ``order_col`` (unique)."""
    rows = df.repartitionByRange(_num_partitions(df, None), order_col).sortWithinPartitions(order_col)
    tagged = cut_lineage(rows.withColumn("_pid", F.spark_partition_id()))
    parts = tagged.groupBy("_pid").agg(F.sum(value_col).alias("_n"))  # one row per task
    offs = F.broadcast(_offsets(parts, [], "_pid", "_n").select("_pid", "_off"))
    local = Window.partitionBy("_pid").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    x = tagged.withColumn("_local", F.coalesce(F.sum(value_col).over(local), F.lit(0)))
    return x.join(offs, "_pid").withColumn(out, F.col("_off") + F.col("_local")).drop("_pid", "_off", "_local")


def dense_index(df: DataFrame, value_col: str, out: str = "idx", partitions: int | None = None) -> DataFrame:
    """Sorted distinct values of ``value_col`` -> (value, 0..n-1), computed without a single-task sort."""
    distinct = df.select(value_col).where(F.col(value_col).isNotNull()).distinct()
    ranked = row_number_within(distinct, [], [value_col], out=out, partitions=partitions)
    return ranked.select(value_col, F.col(out).cast("int").alias(out))

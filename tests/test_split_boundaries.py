"""Boundaries of a split are found without a shuffle of all rows."""

from pyspark.sql import functions as F

from ledgerlens.operators import split


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_boundaries_do_not_shuffle_every_row(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        h = spark.range(1000).select((F.col("id") % 3).alias("_g"), split.split_hash("id").alias("_h"))
        p = plan(split._boundaries(h, split._counts(h), lambda n: F.round(0.2 * n), 3))
        assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

"""What large tables leave on disk."""

import glob

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlens import fixtures as fx
from ledgerlens.plans.preprocess import FeaturePipeline, fit_split
from ledgerlens.session import cut_lineage, ensure_checkpoint_dir, swept
from ledgerlens.sources.writers import write_predictions

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_shuffle_files_go_with_the_action(spark):
    before = spark.conf.get(KEY)
    with pytest.raises(KeyError), swept(spark):
        assert spark.conf.get(KEY) == "true"
        raise KeyError
    assert spark.conf.get(KEY) == before
    df = spark.range(100).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    once = cut_lineage(df)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, df.collect())) == sorted(map(tuple, cut_lineage(df).collect()))


def test_lines_are_stored_as_parquet(spark):
    i = F.col("id").cast("int").cast("string")
    lines = spark.range(40).select(i.alias("Inv_Id"), i.alias("Vendor_Code"), i.alias("GL_Code"), F.col("id").cast("double").alias("Inv_Amt"),
                                   F.lit("a part").alias("Item_Description"), (F.col("id") % 2).cast("string").alias("Product_Category"))
    _, split = fit_split(lines, FeaturePipeline(max_features=5), 0.2, 42)
    assert "parquet" in split._jdf.queryExecution().executedPlan().toString().lower()
    assert split.count() == 40 and split.where("is_val").count() == 8


def test_items_are_shuffled_by_order_only(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fx.invoice_docs_typed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        run = fx.invoice_docs_typed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(first_suppkey" not in run
    assert plan.index("c_custkey") > plan.index("s_suppkey")


def test_predictions_are_written_compressed(spark, tmp):
    write_predictions(spark.range(3).withColumn("t", F.array(F.col("id"))), f"{tmp}/out", compression="gzip")
    assert glob.glob(f"{tmp}/out/*.csv.gz") and not glob.glob(f"{tmp}/out/*.csv")
    back = spark.read.option("header", "true").csv(f"{tmp}/out")
    assert sorted(r.t for r in back.collect()) == ["[0]", "[1]", "[2]"]


def test_a_landed_csv_is_deleted(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/a2-lines-*"))
    got = E.queries()["a2_land_invoice_json_csv"](spark, "/root/testdata/sf0.001")
    assert set(glob.glob(f"{folder}/a2-lines-*")) == before and got.count() == 1500

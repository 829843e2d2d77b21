"""Properties (splits, scores, fit/transform) and plan shapes (no Python in column plans, broadcasts, pushdown)."""

import math

from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlens import fixtures as fx
from ledgerlens.operators import encode, profile, split
from ledgerlens.plans.preprocess import FeaturePipeline
from ledgerlens.plans.score import predict_top3, scored
from ledgerlens.plans.train import train_forest

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_is_disjoint_complete_and_repeatable(spark):
    lines = fx.invoice_lines(spark, SF)
    a = split.stratified_split(lines, "Product_Category", "Inv_Id")
    b = split.stratified_split(lines.repartition(7), "Product_Category", "Inv_Id")
    ra = sorted((r.Inv_Id, r.is_val) for r in a.select("Inv_Id", "is_val").collect())
    rb = sorted((r.Inv_Id, r.is_val) for r in b.select("Inv_Id", "is_val").collect())
    assert ra == rb and len(ra) == lines.count()
    per_class = a.groupBy("Product_Category").agg(F.count(F.lit(1)).alias("n"),
                                                  F.sum(F.col("is_val").cast("int")).alias("v")).collect()
    for r in per_class:
        assert r.v == int(math.floor(0.2 * r.n + 0.5))
    h2 = split.random_split(lines, "Inv_Id").where("is_val").count()
    assert h2 == int(0.2 * lines.count())


def test_dense_index_is_exact(spark):
    lines = fx.invoice_lines(spark, SF)
    d = encode.fit_dictionary(lines, "Vendor_Code").orderBy("idx").collect()
    values = sorted(r[0] for r in lines.select("Vendor_Code").distinct().collect())
    assert [r.value for r in d] == values and [r.idx for r in d] == list(range(len(values)))


def test_transform_on_training_rows_and_scores(spark):
    lines = fx.invoice_lines(spark, SF)
    model = FeaturePipeline(max_features=300).fit(lines)
    feats = model.transform(lines)
    assert feats.count() == lines.count()
    assert feats.where(F.col("label").isNull()).count() == 0
    rf = train_forest(feats, n_trees=5, max_depth=5)
    s = scored(feats, rf, model.class_dict, keep_probabilities=True)
    for r in s.limit(50).collect():
        assert math.isclose(sum(r.probabilities), 1.0, rel_tol=1e-9)
        assert math.isclose(r.Confidence, max(r.probabilities), rel_tol=1e-12)
        assert r.Top_Predictions[0].prob == max(r.probabilities)
    top = predict_top3(lines.drop("Product_Category"), model, rf)
    assert top.where(F.size("Top_Predictions") != 3).count() == 0


def test_forest_beats_majority_class(spark):
    lines = fx.invoice_lines(spark, "/root/testdata/sf0.01")
    model = FeaturePipeline(max_features=500).fit(lines)
    feats = split.stratified_split(model.transform(lines), "Product_Category", "Inv_Id")
    rf = train_forest(feats.where(~F.col("is_val")), n_trees=10, max_depth=10)
    val = scored(feats.where("is_val"), rf, model.class_dict)
    acc = val.agg(F.avg((F.col("Predicted_Category") == F.col("Product_Category")).cast("double"))).first()[0]
    majority = lines.groupBy("Product_Category").count().agg(F.max("count")).first()[0] / lines.count()
    assert acc > majority


def test_no_python_in_column_plans(spark):
    for name in ("c5_feature_table", "b2_parse_number", "d6_text_to_invoice", "g7_tfidf", "h1_stratified_split",
                 "f7_histogram", "j3_classification_report"):
        p = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name


def test_lookups_are_broadcast_and_filters_pushed(spark):
    lines = fx.invoice_lines(spark, SF)
    d = encode.fit_dictionary(lines, "Vendor_Code")
    t = encode.transform_dictionary(lines, "Vendor_Code", d, "v")
    t.count()
    assert "BroadcastHashJoin" in plan(t)
    p = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_suppkey = 3").select("l_orderkey")
    s = p._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_suppkey), EqualTo(l_suppkey,3)]" in s


def test_top_k_per_group_is_limited_before_shuffle(spark):
    lines = fx.invoice_lines(spark, SF)
    ex = profile.examples_per_group(lines, "Product_Category", 2, "Inv_Id", top=3, text_col="Item_Description")
    ex._jdf.queryExecution().executedPlan()
    s = ex._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in s


def test_split_falls_back_to_plain_when_a_class_is_tiny(spark):
    lines = fx.invoice_lines(spark, SF)
    one = lines.where("Product_Category = 'CLASS-1210'").orderBy("Inv_Id").limit(1)
    data = lines.where("Product_Category <> 'CLASS-1210'").unionByName(one)
    n = data.count()
    out = split.stratified_split(data, "Product_Category", "Inv_Id")
    assert out.count() == n
    assert out.where("is_val").count() == math.ceil(0.2 * n)


def test_approximate_quartiles_are_close(spark):
    lines = fx.invoice_lines(spark, SF)
    exact = profile.describe(lines, "Inv_Amt").first()
    approx = profile.describe(lines, "Inv_Amt", exact=False).first()
    spread = exact["max"] - exact["min"]
    for q in ("q25", "q50", "q75"):
        assert abs(exact[q] - approx[q]) <= 0.01 * spread
    box = profile.box_stats(lines, "Inv_Amt", exact=False).first()
    assert box["lower_whisker"] >= exact["min"] and box["upper_whisker"] <= exact["max"]


def test_split_keeps_rows_with_null_class_and_null_key(spark):
    rows = [("a", f"k{i}") for i in range(10)] + [(None, f"n{i}") for i in range(10)] + [("a", None), (None, None), ("b", "x"), ("b", "y")]
    df = spark.createDataFrame(rows, "c string, k string")
    one = split.stratified_split(df, "c", "k")
    assert one.count() == len(rows) and one.where("is_val IS NULL").count() == 0
    val = {r.c: r.n for r in one.where("is_val").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert val.get("a") == 2 and val.get(None) == 2 and val.get("b", 0) == 0
    two = split.random_split(df, "k")
    assert two.count() == len(rows) and two.where("is_val").count() == math.floor(0.2 * len(rows))


def test_split_sides_agree_for_repeated_keys(spark):
    df = spark.createDataFrame([("a", f"k{i % 20}") for i in range(100)], "c string, k string")
    out = split.stratified_split(df, "c", "k")
    assert out.groupBy("k").agg(F.countDistinct("is_val").alias("n")).where("n > 1").count() == 0
    assert out.where("is_val").count() == 20


def test_split_of_an_empty_table(spark):
    df = spark.createDataFrame([], "c string, k string")
    assert split.stratified_split(df, "c", "k").count() == 0 and split.random_split(df, "k").count() == 0


def test_split_shuffles_no_payload(spark):
    lines = fx.invoice_lines(spark, SF).withColumn("payload", F.repeat(F.lit("x"), 100))
    p = split.stratified_split(lines, "Product_Category", "Inv_Id")._jdf.queryExecution().executedPlan().toString()
    for line in p.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "payload" not in line
    assert "Sort [Product_Category" not in p


def test_large_dictionary_is_not_broadcast_and_hot_codes_are_split(spark, monkeypatch):
    monkeypatch.setattr(encode, "BROADCAST_BYTES", 0)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                          "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10k")
        hot = spark.range(0, 60000, 1, 12).select(
            F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("v"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        t = encode.encode_lookup(hot, "v", encode.fit_dictionary(hot, "v"), "i")
        assert len(t.collect()) == 60000
        assert "BroadcastHashJoin" not in plan(t) and "skew=true" in plan(t)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_terms_are_counted_by_row_not_by_id(spark):
    df = spark.createDataFrame([(1, "red car red"), (1, "red bus"), (2, "red car"), (3, None), (4, "")], "id int, t string")
    stats = {r["term"]: (r["count"], r["df"]) for r in encode.term_stats(df, "t").collect()}
    assert stats["red"] == (4, 3) and stats["car"] == (2, 2) and stats["red car"] == (2, 2) and stats["red bus"] == (1, 1)
    capped = encode.fit_vocabulary(encode.term_stats(df, "t"), 5, 100, 1, 1.0)
    free = encode.fit_vocabulary(encode.term_stats(df, "t"), 5, None, 1, 1.0)
    assert sorted(map(tuple, capped.collect())) == sorted(map(tuple, free.collect()))
    a = encode.tfidf(df, "id", "t", capped, 100)
    b = encode.tfidf(df, "id", "t", free, None)
    key = lambda r: (r["id"], r["term"], r["idx"], round(r["weight"], 12))
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_terms_plan_has_no_text_shuffle(spark):
    p = plan(encode.term_stats(spark.read.parquet(f"{SF}/documents.parquet"), "text"))
    assert p.count("Exchange") == 1 and "hashpartitioning(term" in p


def test_exact_quartiles_without_a_value_map(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 1, 4, 4, 9, None or 2, 7, 7, 7, 3]] + [(None,)], "x double")
    import numpy as np
    want = np.percentile([5, 1, 4, 4, 9, 2, 7, 7, 7, 3], [25, 50, 75]).tolist()
    r = profile.describe(df, "x")
    assert "percentile" not in plan(r)
    row = r.first()
    assert [row["q25"], row["q50"], row["q75"]] == want and row["count"] == 10
    empty = profile.describe(df.where("x > 100"), "x").first()
    assert empty["count"] == 0 and empty["q50"] is None


def test_pipeline_uses_its_own_text_column(spark):
    rows = [("1", "v", "g", 1.0, "nothing here", "apple pie", "a"), ("2", "v", "g", 2.0, "other words", "apple tart", "b")] * 3
    df = spark.createDataFrame(rows, "Inv_Id string, Vendor_Code string, GL_Code string, Inv_Amt double, "
                                     "Item_Description string, Body string, Product_Category string")
    model = FeaturePipeline(text_col="Body", min_df=1, max_df=1.0).fit(df)
    assert "apple" in model.vocabulary and "nothing" not in model.vocabulary
    got = encode.vector_entries(model.transform(df), "tfidf", ["Inv_Id"])
    assert got.count() > 0


def test_no_best_model_is_an_error(spark):
    import pytest
    from ledgerlens.operators.evaluate import select_best
    df = spark.createDataFrame([("a", 1, 0.0), ("b", 2, 0.0)], "model string, train_order int, f1_weighted double")
    with pytest.raises(ValueError):
        select_best(df)

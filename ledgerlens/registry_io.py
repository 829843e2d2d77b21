"""Registered round trips of sources, sinks and saved state.

Each query writes what Spark derives from the given tables below the shared
checkpoint folder and returns what the reader under test gets back.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from . import fixtures as fx
from .functions import docs, fields
from .operators import encode, evaluate, profile, sketches
from .plans.score import predict_batch, predict_top3
from .registry import query, rnd
from .registry_models import logistic, parted
from .session import ensure_checkpoint_dir, table
from .sources import persist, readers, writers
from .streaming.score_stream import batch_sink, start_scoring


def scratch(spark, name: str) -> str:
    """A path of its own in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("a1_scan_invoice_lines")
def a1_scan_invoice_lines(spark, d):
    """A1: all lines with nulls as CSV, read with the declared schema."""
    path = scratch(spark, "a1")
    writers.write_table(fx.invoice_lines_nulls(spark, d), path, "csv")
    return rnd(readers.scan_invoice_lines(spark, path))


@query("a2_scan_invoice_json_csv")
def a2_scan_invoice_json_csv(spark, d):
    """A2: JSON documents (broken ones too) in quoted CSV cells -> features."""
    path = scratch(spark, "a2")
    src = fx.invoice_docs_broken(spark, d).select(F.col("file_name").alias("File Name"), F.col("json_data").alias("Json Data"))
    writers.write_table(src, path, "csv")
    f = docs.feature_table(readers.scan_invoice_json_csv(spark, path, multi_line=False))
    return rnd(f.select("file_name", "seller_name", "client_name", "num_items", "total_items_price", "total"))


@query("a2_land_invoice_json_csv")
def a2_land_invoice_json_csv(spark, d):
    """A2: JSON documents with line ends inside quoted cells, read whole, landed and parsed."""
    path, out = scratch(spark, "a2-lines"), scratch(spark, "a2-landed")
    lines = F.regexp_replace("json_data", r'(,)(")', "$1\n$2")  # a line end after every comma before a key or text
    src = fx.invoice_docs_broken(spark, d).select(F.col("file_name").alias("File Name"), lines.alias("Json Data"))
    writers.write_table(src, path, "csv", compression="snappy")  # a file with line ends in its cells is one task's anyway
    landed = readers.land_invoice_json_csv(spark, path, out)
    writers.delete_path(spark, path)  # landed, so nothing reads it any more
    f = docs.feature_table(landed)
    return rnd(f.select("file_name", "seller_name", "client_name", "num_items", "total_items_price", "total"))


@query("a3_scan_invoice_json_files")
def a3_scan_invoice_json_files(spark, d):
    """A3: one JSON document per nation (its customers' orders as items) in a file of its own -> features."""
    path = scratch(spark, "a3")
    o = table(spark, d, "orders").select("o_custkey", "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    # Summed by customer segment of hundred first: a document's items are as many as its customers' hundreds.
    by = (o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey", F.floor(F.col("c_custkey") / 100).alias("block"))
          .agg(F.sum(F.col("o_totalprice").cast("decimal(15,2)")).cast("decimal(18,2)").alias("v"), F.count(F.lit(1)).alias("k")))
    item = F.struct(F.concat(F.lit("block "), F.col("block").cast("string")).alias("description"),
                    F.col("k").cast("string").alias("quantity"), F.col("v").cast("string").alias("total_price"))
    g = by.groupBy("c_nationkey").agg(F.sort_array(F.collect_list(item)).alias("items"), F.sum("v").alias("v"))
    doc = F.struct(F.struct(F.col("n_name").alias("seller_name")).alias("invoice"), F.col("items"),
                   F.struct(F.col("v").cast("string").alias("total")).alias("subtotal"))
    rows = g.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_nationkey", F.to_json(doc).alias("value"))
    rows.repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    got = readers.scan_invoice_json_files(spark, path)
    f = docs.feature_table(got.select("file_name", "json_data"))
    return rnd(f.select("seller_name", "num_items", "total_quantity", "total_items_price", "total"), 2)


@query("a5_write_features")
def a5_write_features(spark, d):
    """A5: the feature table as CSV and back."""
    path = scratch(spark, "a5")
    f = docs.feature_table(fx.invoice_docs_broken(spark, d))
    writers.write_features(f, path)
    back = spark.read.schema(f.schema).option("header", "true").option("escape", '"').csv(path)
    return rnd(back.select("file_name", F.coalesce("seller_name", F.lit("")).alias("seller_name"), "num_items", "tax",
                           "total", "tax_rate", "invoice_year", "days_until_due"))


@query("a6_write_invoice_json")
def a6_write_invoice_json(spark, d):
    """Documents as JSON lines and back."""
    path = scratch(spark, "a6")
    writers.write_invoice_json(docs.parse_invoice_frame(fx.invoice_docs(spark, d)), path)
    back = spark.read.schema("file_name string, invoice struct<invoice_number:string,client_name:string>, "
                             "items array<struct<description:string>>, subtotal struct<total:string>").json(path)
    return back.select("file_name", F.col("invoice.invoice_number").alias("invoice_number"),
                       F.col("invoice.client_name").alias("client_name"), F.size("items").alias("n_items"),
                       F.col("subtotal.total").alias("total"))


@query("a7_write_predictions")
def a7_write_predictions(spark, d):
    """Scored lines as CSV, the three best classes as JSON text, and back."""
    path = scratch(spark, "a7")
    model, _, _ = parted(spark, d)
    writers.write_predictions(predict_top3(fx.invoice_lines(spark, d).drop("Product_Category"), model, logistic(spark, d)),
                              path, compression="gzip")
    back = spark.read.option("header", "true").option("escape", '"').csv(path)
    top = F.from_json("Top_Predictions", "array<struct<label:string,prob:double>>")
    return back.select("Inv_Id", "Vendor_Code", F.size(top).alias("n_top"),
                       (top[0]["label"] == F.col("Predicted_Category")).alias("first_is_prediction"),
                       (F.abs(top[0]["prob"] - F.col("Confidence").cast("double")) < 1e-9).alias("first_is_confidence"))


SKETCHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"]


def stored_sketches(spark, d):
    """Sketches of all lines by ship year, stored in two steps (odd and even orders) and read back."""
    path = scratch(spark, "sketches")
    li = table(spark, d, "lineitem").select(*SKETCHED, F.year("l_shipdate").alias("year"))
    for odd in (0, 1):
        sketches.column_sketches(li.where(F.col("l_orderkey") % 2 == odd), SKETCHED, by=["year"]).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("f3_n_unique_sketch")
def f3_n_unique_sketch(spark, d):
    """F3 from stored sketches united over years and steps, beside the exact counts: within four standard errors."""
    stored = stored_sketches(spark, d)
    guess = sketches.n_unique_of(sketches.unite(stored)).withColumnRenamed("n_unique", "guess")
    exact = profile.n_unique(table(spark, d, "lineitem"), SKETCHED)
    near = F.abs(F.col("guess") - F.col("n_unique")) <= 1 + 4 * sketches.distinct_error() * F.col("n_unique")
    return exact.join(guess, "column_name").select("column_name", "n_unique", near.alias("within_bound"))


@query("f5_describe_sketch")
def f5_describe_sketch(spark, d):
    """F5 by year from stored sketches: exact counts and moments, quartiles within twice the stated rank error."""
    numbers = SKETCHED[:5]
    got = sketches.describe_of(sketches.unite(stored_sketches(spark, d), by=["year"]), by=["year"]).where(F.col("column_name").isin(numbers))
    li = table(spark, d, "lineitem").select(F.year("l_shipdate").alias("year"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in numbers])).alias("v")).select("year", "v.*")
    j = li.join(F.broadcast(got), ["year", "column_name"])  # a row for each year and column
    most = 2 * sketches.rank_error()

    def near(q, p):
        """Whether the ranks of the value, from below and with its ties, reach within the error of p."""
        n = F.count(F.lit(1))
        return ((F.sum((F.col("x") < F.col(q)).cast("long")) / n <= p + most)
                & (F.sum((F.col("x") <= F.col(q)).cast("long")) / n >= p - most)).alias(f"{q}_within_bound")
    ranks = j.groupBy("year", "column_name").agg(*[near(q, p) for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))])
    return rnd(got.join(ranks, ["year", "column_name"]).select(
        "year", "column_name", "count", "mean", "std", "min", "max", "q25_within_bound", "q50_within_bound", "q75_within_bound"), 4)


@query("a10_pipeline_round_trip")
def a10_pipeline_round_trip(spark, d):
    """A10: the fitted pipeline saved and loaded gives the same vector for every line."""
    path = scratch(spark, "a10")
    model, _, _ = parted(spark, d)
    persist.save_pipeline(model, path)
    lines = fx.invoice_lines_nulls(spark, d).drop("Product_Category")
    once = model.transform(lines).select(*lines.columns, F.col("features").alias("a"))
    both = persist.load_pipeline(spark, path).transform(once).select("Inv_Id", "a", F.col("features").alias("b"))
    return both.select("Inv_Id", (F.unwrap_udt(F.col("a")) == F.unwrap_udt(F.col("b"))).alias("same"))


@query("a11_model_round_trip")
def a11_model_round_trip(spark, d):
    """The saved model scores every line as the fitted one; its name, score and results come back."""
    path = scratch(spark, "a11")
    model, _, _ = parted(spark, d)
    lr = logistic(spark, d)
    results = evaluate.compare_models([evaluate.model_summary("logistic_regression", 1, fx.fake_predictions(spark, d))])
    persist.save_model(spark, lr, path, "logistic_regression", 0.5, results)
    again, name, best, back = persist.load_model(spark, path)
    lines = fx.invoice_lines_nulls(spark, d).drop("Product_Category")
    one = predict_batch(lines, model, lr).withColumnRenamed("Predicted_Category", "p1").withColumnRenamed("Confidence", "c1")
    two = predict_batch(one, model, again)
    rows = back.agg(F.count(F.lit(1))).scalar()
    return two.select("Inv_Id", ((F.col("p1") == F.col("Predicted_Category")) & (F.col("c1") == F.col("Confidence"))).alias("same"),
                      F.lit(name).alias("model"), F.lit(best).alias("score"), rows.alias("n_results"))


@query("a12_label_mapping")
def a12_label_mapping(spark, d):
    """The class dictionary written as JSON lines and read back."""
    path = scratch(spark, "a12")
    persist.write_label_mapping(encode.fit_dictionary(fx.invoice_lines(spark, d), "Product_Category"), path)
    return persist.read_label_mapping(spark, path).select("idx", F.col("value").alias("label"))


@query("a13_scan_labels")
def a13_scan_labels(spark, d):
    """A label table written as CSV, read with its schema and summed up."""
    path = scratch(spark, "a13")
    writers.write_table(fx.invoice_lines(spark, d).select("Inv_Id", "Product_Category"), path, "csv")
    return readers.label_summary(readers.scan_labels(spark, path))


@query("d8_template_extract")
def d8_template_extract(spark, d):
    """German fuel invoices rendered from all orders, read by template rules."""
    t = fx.german_invoices(spark, d).select("o_orderkey", fields.template_extract("text", fx.GERMAN_RULES).alias("_doc"))
    return t.select(
        "o_orderkey", "_doc.invoice.seller_name", "_doc.invoice.invoice_number", "_doc.invoice.invoice_date",
        "_doc.invoice.due_date", F.size("_doc.items").alias("n_items"), F.get("_doc.items", F.lit(0))["quantity"].alias("quantity"),
        F.get("_doc.items", F.lit(0))["total_price"].alias("total_price"), "_doc.subtotal.net", "_doc.subtotal.tax",
        "_doc.subtotal.total", "_doc.payment_instructions.iban", "_doc.payment_instructions.bank_name")


@query("k8_score_stream")
def k8_score_stream(spark, d):
    """K8: lines arriving as CSV files, scored by the stream, against batch scoring of the same files."""
    inp, out, ckpt = (scratch(spark, n) for n in ("k8-in", "k8-out", "k8-ckpt"))
    model, _, _ = parted(spark, d)
    lr = logistic(spark, d)
    writers.write_table(fx.invoice_lines_nulls(spark, d).drop("Product_Category"), inp, "csv", compression="gzip")
    start_scoring(spark, inp, out, ckpt, model, lr).awaitTermination()
    return _against_batch(spark, {"n_rows": spark.read.parquet(out)}, inp, model, lr)


@query("k8_stream_restart")
def k8_stream_restart(spark, d):
    """K8 in four starts from one checkpoint: files arrive before each of the first three, none before the last.

    Starts one and two go through the file sink in batches of two files; the same files also go through the batch sink, in other
    steps. Each must hold every line once, as batch scoring gives it.
    """
    inp, out, out2, ckpt, ckpt2 = (scratch(spark, n) for n in ("k8r-in", "k8r-out", "k8r-out2", "k8r-ckpt", "k8r-ckpt2"))
    model, _, _ = parted(spark, d)
    lr = logistic(spark, d)
    lines = fx.invoice_lines_nulls(spark, d).drop("Product_Category")
    part = F.pmod(F.xxhash64("Inv_Id"), F.lit(3))
    for step in range(4):
        if step < 3:
            writers.write_table(lines.where(part == step).repartition(5), inp, "csv", mode="append", compression="gzip")
        start_scoring(spark, inp, out, ckpt, model, lr, max_files_per_trigger=2).awaitTermination()
        if step != 1:  # the second sink sees the files of two steps at once
            start_scoring(spark, inp, out2, ckpt2, model, lr, max_files_per_trigger=4, sink=batch_sink(out2)).awaitTermination()
    streamed = {"n_rows": spark.read.parquet(out), "n2": spark.read.parquet(out2).drop("batch_id")}
    both = _against_batch(spark, streamed, inp, model, lr)
    return both.select("Inv_Id", "Vendor_Code", "GL_Code", "n_rows", "same_as_batch", (F.col("n_rows") == F.col("n2")).alias("same_in_both"))


def _against_batch(spark, streamed, inp, model, lr):
    """Per line key, the rows of each stream and whether they all are those of batch scoring of the same files.

    The files are scored once, and all rows are dealt out once, by the key that both counts below are grouped by.
    """
    sides = {"_batch": predict_batch(readers.scan_invoice_lines(spark, inp, labelled=False), model, lr), **streamed}
    key, rows = ["Inv_Id", "Vendor_Code", "GL_Code"], None
    for side, df in sides.items():
        x = df.select(*key, "Predicted_Category", F.round("Confidence", 9).alias("c"), F.lit(side).alias("side"))
        rows = x if rows is None else rows.unionByName(x)
    counts = rows.repartition(*key).groupBy(*key, "Predicted_Category", "c").agg(
        *[F.count(F.when(F.col("side") == side, 1)).alias(side) for side in sides])
    same = [F.col(side) == F.col("_batch") for side in streamed]
    return counts.groupBy(*key).agg(*[F.sum(side).alias(side) for side in streamed],
                                    F.bool_and(reduce(and_, same)).alias("same_as_batch"))

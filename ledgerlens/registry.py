"""Registered queries: one per operator of SURVEY section 2, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (or views Spark derives from them) in
full. Doubles are rounded at the end so that the DuckDB oracle
(``oracle.py``) can compare values exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixtures as fx
from .functions import arrays, dates, docs, fields, numbers, text
from .session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def rnd(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column (for exact comparison with the oracle)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------------------------------------------
# C: JSON documents -> features


def _features(spark, d, broken=True, keep=("file_name",)):
    src = fx.invoice_docs_broken(spark, d) if broken else fx.invoice_docs(spark, d)
    return docs.feature_table(src, "json_data", keep=keep)


@query("c5_feature_table")
def c5_feature_table(spark, d):
    """C5 over the broken documents: truncated JSON, '$'/comma numbers and missing dates included."""
    return rnd(_features(spark, d, broken=True))


@query("c4_all_features")
def c4_all_features(spark, d):
    return rnd(_features(spark, d, broken=False))


@query("c1_text_features")
def c1_text_features(spark, d):
    f = _features(spark, d, broken=True)
    return f.select("file_name", "seller_name", "client_name", "invoice_number", "item_descriptions", "num_items",
                    "combined_text", "ocr_text")


@query("c2_numeric_features")
def c2_numeric_features(spark, d):
    f = _features(spark, d, broken=True)
    return rnd(f.select("file_name", "num_items", "total_quantity", "total_items_price", "avg_item_price", "tax",
                        "discount", "total", "tax_rate", "discount_rate"))


@query("c3_date_features")
def c3_date_features(spark, d):
    f = _features(spark, d, broken=True)
    return f.select("file_name", "invoice_year", "invoice_month", "invoice_day", "invoice_weekday",
                    "invoice_quarter", "days_until_due")


@query("c6_items_exploded")
def c6_items_exploded(spark, d):
    parsed = docs.parse_invoice_frame(fx.invoice_docs_broken(spark, d), "json_data", "_doc", ("file_name",))
    return rnd(docs.items_exploded(parsed, "_doc", keep=("file_name",)))


# ---------------------------------------------------------------------------------------------------
# B: scalar functions


@query("b1_clean_text")
def b1_clean_text(spark, d):
    """B1 over every document text (whole texts, four languages)."""
    return table(spark, d, "documents").select("doc_id", text.clean_text("text").alias("clean"))


@query("b2_parse_number")
def b2_parse_number(spark, d):
    """B2 over amount strings in several layouts built from every line item."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            "l_extendedprice", "l_quantity")
    price = F.col("l_extendedprice").cast("decimal(15,2)").cast("string")
    qty = F.col("l_quantity").cast("bigint").cast("string")
    k = F.col("l_linenumber") % 7
    s = (F.when(k == 0, F.concat(F.lit("$"), price))
         .when(k == 1, F.regexp_replace(price, r"\.", ","))
         .when(k == 2, F.concat(price, F.lit(" EUR")))
         .when(k == 3, F.concat(qty, F.lit(" Liter")))
         .when(k == 4, F.concat(price, F.lit("."), F.col("l_linenumber").cast("string")))
         .when(k == 5, F.concat(F.lit("-"), price))
         .otherwise(F.lit("")))
    keyed = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", s.alias("s"))
    return rnd(keyed.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "s",
                            numbers.parse_number("s").alias("value")))


def _date_strings(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey") % 8
    dt = F.col("o_orderdate")
    s = (F.when(k == 0, F.date_format(dt, "MM/dd/yyyy"))
         .when(k == 1, F.date_format(dt, "dd/MM/yyyy"))
         .when(k == 2, F.date_format(dt, "yyyy-MM-dd"))
         .when(k == 3, F.date_format(dt, "MM-dd-yyyy"))
         .when(k == 4, F.date_format(dt, "dd.MM.yyyy"))
         .when(k == 5, F.concat(F.lit("  "), F.date_format(dt, "M/d/yyyy"), F.lit(" ")))
         .when(k == 6, F.date_format(dt, "MM/dd/yy"))
         .otherwise(F.date_format(dt, "yyyy/MM/dd")))
    return o.select("o_orderkey", s.alias("s"))


@query("b3_parse_date")
def b3_parse_date(spark, d):
    """B3 over order dates printed in eight layouts (two of them unparseable)."""
    return _date_strings(spark, d).select("o_orderkey", "s", dates.parse_date("s").cast("string").alias("parsed"))


@query("b4_parse_invoice_json")
def b4_parse_invoice_json(spark, d):
    p = docs.parse_invoice_frame(fx.invoice_docs_broken(spark, d), "json_data", "_doc", ("file_name",))
    return p.select("file_name", F.col("_doc").isNull().alias("is_empty"),
                    F.coalesce(F.size("_doc.items"), F.lit(0)).alias("n_items"),
                    F.col("_doc.invoice.invoice_date").alias("invoice_date"))


@query("b5_fill_defaults")
def b5_fill_defaults(spark, d):
    from .plans.preprocess import fill_defaults
    return fill_defaults(fx.invoice_lines_nulls(spark, d))


@query("b6_safe_ratio")
def b6_safe_ratio(spark, d):
    """Order total over customer balance (negative or zero balance -> 0)."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return rnd(j.select("o_orderkey", numbers.safe_ratio("o_totalprice", "c_acctbal").alias("ratio")))


@query("b7_date_parts")
def b7_date_parts(spark, d):
    """B7 over parsed date strings (unparseable ones give zeros)."""
    s = _date_strings(spark, d)
    p = dates.date_parts(dates.parse_date("s"))
    return s.select("o_orderkey", *[v.alias(k) for k, v in p.items()])


@query("b8_days_between")
def b8_days_between(spark, d):
    """Ship date minus order date per line (negative allowed)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    dates.days_between(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
                    .alias("days"))


@query("b9_text_stats")
def b9_text_stats(spark, d):
    t = table(spark, d, "documents")
    return t.select("doc_id", text.text_length("text").alias("n_chars"), text.word_count("text").alias("n_words"))


@query("b10_general_category")
def b10_general_category(spark, d):
    """B10 over every document text (substring rules hit inside words, as in the reference)."""
    t = table(spark, d, "documents")
    return t.select("doc_id", text.general_category("text").alias("general_category"))


@query("b10_general_category_lines")
def b10_general_category_lines(spark, d):
    lines = fx.invoice_lines_nulls(spark, d)
    return lines.select("Inv_Id", text.general_category("Item_Description").alias("general_category"))


@query("b11_preview")
def b11_preview(spark, d):
    t = table(spark, d, "documents")
    return t.select("doc_id", text.preview("text", 100).alias("preview"))


@query("b12_numeric_vector")
def b12_numeric_vector(spark, d):
    """The 15-float vector of every feature row, one row per (file, position)."""
    f = _features(spark, d, broken=True)
    v = f.select("file_name", docs.numeric_vector(f))
    # posexplode_outer (the vector always has entries): for a plain one the optimizer infers a filter on the vector's size,
    # with the whole expression inlined, and every document would be processed twice.
    e = v.select("file_name", F.posexplode_outer("numeric_features").alias("pos", "value"))
    return e.select("file_name", "pos", F.round(F.col("value").cast("double"), 2).alias("value"))


@query("b13_filter_category")
def b13_filter_category(spark, d):
    lines = fx.invoice_lines(spark, d)
    return rnd(lines.where(F.col("Product_Category") == "CLASS-1210"))


@query("b14_combined_text")
def b14_combined_text(spark, d):
    f = _features(spark, d, broken=True)
    return f.select("file_name", text.combined_text("seller_name", "client_name", "item_descriptions")
                    .alias("combined_text"))


@query("b15_text_column")
def b15_text_column(spark, d):
    return _features(spark, d, broken=False).select("combined_text")


# ---------------------------------------------------------------------------------------------------
# D: text -> fields


def _itext(spark, d):
    return fx.invoice_text(spark, d)


@query("d1_invoice_number")
def d1_invoice_number(spark, d):
    return _itext(spark, d).select("o_orderkey", fields.invoice_number("text").alias("invoice_number"))


@query("d2_date_field")
def d2_date_field(spark, d):
    t = _itext(spark, d)
    return t.select("o_orderkey", fields.date_field("text", "invoice").alias("invoice_date"),
                    fields.date_field("text", "due").alias("due_date"))


@query("d3_parties")
def d3_parties(spark, d):
    p = fields.parties(F.col("text"))
    return _itext(spark, d).select("o_orderkey", *[v.alias(k) for k, v in p.items()])


@query("d4_line_items")
def d4_line_items(spark, d):
    t = _itext(spark, d).select("o_orderkey", F.posexplode_outer(fields.line_items("text")).alias("item_pos", "item"))
    return t.where("item IS NOT NULL").select("o_orderkey", "item_pos", "item.description", "item.quantity", "item.total_price")


@query("d5_totals")
def d5_totals(spark, d):
    tt = fields.totals(F.col("text"))
    return _itext(spark, d).select("o_orderkey", *[v.alias(k) for k, v in tt.items()])


@query("d6_text_to_invoice")
def d6_text_to_invoice(spark, d):
    """D6 then C4: features of the documents read back from the invoice text."""
    from .plans.features import text_to_features
    return rnd(text_to_features(_itext(spark, d), "text", keep=("o_orderkey",)).drop("ocr_text", "_doc"))


@query("d7_batch_text_to_invoice")
def d7_batch_text_to_invoice(spark, d):
    """D7 over all document texts: documents with text -> parsed; blank or null text -> quarantine.

    Every document comes with a second row, its id negated, that is blank or null.
    """
    from .plans.features import batch_text_to_invoice
    t = table(spark, d, "documents").select("doc_id", "text")
    k = F.col("doc_id") % 4
    blank = (F.when(k == 0, F.lit("\n\t")).when(k == 1, F.lit("")).when(k == 2, F.lit(" \u00a0\u2003 "))
             .otherwise(F.lit(None).cast("string")))
    more = t.select((-1 - F.col("doc_id")).alias("doc_id"), blank.alias("text"))
    good, bad = batch_text_to_invoice(t.unionByName(more), "text", keep=("doc_id",))
    g = good.select("doc_id", F.lit("parsed").alias("status"), F.col("_doc.invoice.invoice_number").alias(
        "invoice_number"), F.size("_doc.items").alias("n_items"), F.col("_doc.subtotal.total").alias("total"))
    b = bad.select("doc_id", F.lit("quarantined").alias("status"), F.lit(None).cast("string").alias(
        "invoice_number"), F.lit(None).cast("int").alias("n_items"), F.lit(None).cast("string").alias("total"))
    return g.unionByName(b)


# ---------------------------------------------------------------------------------------------------
# W / K7: per-row class scores (embeddings as logits)


def _logits(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", "embedding")


@query("w2_top_k_per_row")
def w2_top_k_per_row(spark, d):
    p = arrays.softmax_frame(_logits(spark, d), "embedding", "prob")
    e = p.select("vec_id", F.posexplode_outer(arrays.top_k_per_row("prob", 3)).alias("rank", "p"))
    return rnd(e.select("vec_id", "rank", F.col("p.idx").alias("idx"), F.col("p.prob").alias("prob")))


@query("w3_argmax")
def w3_argmax(spark, d):
    return _logits(spark, d).select("vec_id", arrays.argmax("embedding").alias("argmax"))


@query("k7_softmax")
def k7_softmax(spark, d):
    p = arrays.softmax_frame(_logits(spark, d), "embedding", "p")
    return rnd(p.select("vec_id", F.posexplode_outer("p").alias("idx", "prob")), 9)


# ---------------------------------------------------------------------------------------------------
# E / G1-G3 / A12: lookups and dictionaries

from .operators import encode, evaluate, joins, profile, split  # noqa: E402


@query("e1_attach_labels")
def e1_attach_labels(spark, d):
    """Documents left-joined to their quality labels by key."""
    docs_t = table(spark, d, "documents").select("doc_id")
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return joins.attach_labels(docs_t, labels, "doc_id", "left").select("doc_id", "quality")


@query("e3_encode_lookup")
def e3_encode_lookup(spark, d):
    lines = fx.invoice_lines(spark, d)
    dic = encode.fit_dictionary(lines, "Vendor_Code")
    return encode.encode_lookup(lines, "Vendor_Code", dic, "vendor_idx").select("Inv_Id", "vendor_idx")


def _third(spark, d):
    """(fit, all): lines of every third part fit a dictionary; all lines are looked up in it."""
    k = fx.lines_keyed(spark, d)
    return k.where(F.col("l_partkey") % 3 == 0), k


@query("g2_transform_dictionary")
def g2_transform_dictionary(spark, d):
    """Description dictionary fitted on every third part, applied to all lines (unseen -> 0)."""
    fit, lines = _third(spark, d)
    dic = encode.fit_dictionary(fit, "Item_Description")
    return encode.transform_dictionary(lines, "Item_Description", dic, "desc_idx").select("Inv_Id", "desc_idx")


@query("g2_unseen_vendors")
def g2_unseen_vendors(spark, d):
    """Vendor dictionary without the last suppliers, applied to all lines (theirs -> 0)."""
    fit, _ = fx.lines_unseen(spark, d)
    dic = encode.fit_dictionary(fit, "Vendor_Code")
    lines = fx.invoice_lines(spark, d)
    return encode.transform_dictionary(lines, "Vendor_Code", dic, "vendor_idx").select("Inv_Id", "vendor_idx")


@query("e4_decode_labels")
def e4_decode_labels(spark, d):
    p = fx.fake_predictions(spark, d)
    classes = encode.fit_dictionary(p, "y_true")
    idx = encode.encode_lookup(p, "y_pred", classes, "pred_idx")
    return encode.decode_labels(idx, "pred_idx", classes, "pred_label").select("Inv_Id", "pred_idx", "pred_label")


@query("e5_known_values")
def e5_known_values(spark, d):
    fit, lines = _third(spark, d)
    return encode.known_values(lines, "Item_Description", encode.fit_dictionary(fit, "Item_Description")).select(
        "Inv_Id", "Item_Description")


@query("e5_unseen_values")
def e5_unseen_values(spark, d):
    fit, lines = _third(spark, d)
    return encode.unseen_values(lines, "Item_Description", encode.fit_dictionary(fit, "Item_Description")).select(
        "Inv_Id", "Item_Description")


@query("g1_fit_dictionary")
def g1_fit_dictionary(spark, d):
    lines = fx.invoice_lines(spark, d)
    parts = [encode.fit_dictionary(lines, c).select(F.lit(c).alias("column_name"), "value", "idx")
             for c in ("Vendor_Code", "GL_Code", "Product_Category")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("g3_scaler")
def g3_scaler(spark, d):
    """The fitted scaler of the pipeline, applied to every line."""
    lines = fx.invoice_lines(spark, d)
    scaler = encode.fit_scaler(lines, "Inv_Amt")
    return rnd(lines.select("Inv_Id", scaler.transform("Inv_Amt").alias("amount_scaled")))


# ---------------------------------------------------------------------------------------------------
# Tokens, n-grams, vocabulary, TF-IDF over every document text


def _term_stats(spark, d):
    return encode.term_stats(table(spark, d, "documents"), "text", 2)


def _vocab(spark, d):
    n = table(spark, d, "documents").agg(F.count(F.lit(1))).scalar()
    return encode.fit_vocabulary(_term_stats(spark, d), n, 5000, 2, 0.95)


@query("g4_tokens")
def g4_tokens(spark, d):
    t = table(spark, d, "documents")
    return t.select("doc_id", F.size(text.tokens(text.clean_text("text"))).alias("n_tokens"))


@query("g5_ngrams")
def g5_ngrams(spark, d):
    """Corpus count and document frequency of every 1-2-gram."""
    return _term_stats(spark, d)


@query("g6_fit_vocabulary")
def g6_fit_vocabulary(spark, d):
    return rnd(_vocab(spark, d), 9)


@query("g7_tfidf")
def g7_tfidf(spark, d):
    return rnd(encode.tfidf(table(spark, d, "documents"), "doc_id", "text", _vocab(spark, d)), 6)


# ---------------------------------------------------------------------------------------------------
# H: splits


@query("h1_stratified_split")
def h1_stratified_split(spark, d):
    lines = fx.invoice_lines(spark, d)
    return split.stratified_split(lines, "Product_Category", "Inv_Id", 0.2, 42).select("Inv_Id", "is_val")


@query("h1_stratified_split_nulls")
def h1_stratified_split_nulls(spark, d):
    """H1 by GL code with nulls: the null class is split like any other."""
    lines = fx.invoice_lines_nulls(spark, d)
    return split.stratified_split(lines, "GL_Code", "Inv_Id", 0.2, 42).select("Inv_Id", "GL_Code", "is_val")


@query("h2_random_split")
def h2_random_split(spark, d):
    lines = fx.invoice_lines(spark, d)
    return split.random_split(lines, "Inv_Id", 0.2, 42).select("Inv_Id", "is_val")


# ---------------------------------------------------------------------------------------------------
# F / W1 / K3: profiling


def _lines_nulls(spark, d):
    return fx.invoice_lines_nulls(spark, d)


@query("f1_shape")
def f1_shape(spark, d):
    return profile.shape(fx.invoice_lines(spark, d))


@query("f2_null_counts")
def f2_null_counts(spark, d):
    return profile.null_counts(_lines_nulls(spark, d))


@query("f3_n_unique")
def f3_n_unique(spark, d):
    return profile.n_unique(_lines_nulls(spark, d))


@query("f4_value_counts")
def f4_value_counts(spark, d):
    return profile.value_counts(_lines_nulls(spark, d), "Vendor_Code", 5)


@query("f4_value_counts_class")
def f4_value_counts_class(spark, d):
    return profile.value_counts(_lines_nulls(spark, d), "Product_Category")


@query("f5_describe")
def f5_describe(spark, d):
    return rnd(profile.describe(_lines_nulls(spark, d), "Inv_Amt"))


@query("f6_column_info")
def f6_column_info(spark, d):
    return profile.column_info(_lines_nulls(spark, d))


@query("f7_histogram")
def f7_histogram(spark, d):
    return rnd(profile.histogram(_lines_nulls(spark, d), "Inv_Amt", 50))


@query("f8_box_stats")
def f8_box_stats(spark, d):
    return rnd(profile.box_stats(_lines_nulls(spark, d), "Inv_Amt"))


@query("f9_examples_top3")
def f9_examples_top3(spark, d):
    """two example lines for each of the three largest classes."""
    return profile.examples_per_group(fx.invoice_lines(spark, d), "Product_Category", 2, "Inv_Id", top=3,
                                      text_col="Item_Description")


@query("f9_examples_general")
def f9_examples_general(spark, d):
    """three example documents for every general category of the document texts, with counts."""
    t = table(spark, d, "documents").select("doc_id", text.general_category("text").alias("general_category"),
                                            text.preview("text", 100).alias("preview"))
    return profile.examples_per_group(t, "general_category", 3, "doc_id", text_col="preview")


@query("f10_word_frequency")
def f10_word_frequency(spark, d):
    return profile.word_frequency(table(spark, d, "documents"), "text", 30)


@query("f11_class_distribution")
def f11_class_distribution(spark, d):
    return profile.class_distribution(fx.invoice_lines(spark, d), "Product_Category")


@query("f12_head")
def f12_head(spark, d):
    return rnd(profile.head(fx.invoice_lines(spark, d), 5, "Inv_Id"))


@query("f13_top_categories")
def f13_top_categories(spark, d):
    return profile.bar_data(fx.invoice_lines(spark, d), "Product_Category", "Item_Description")["top_categories"]


@query("f13_top_words")
def f13_top_words(spark, d):
    return profile.bar_data(_lines_nulls(spark, d), "Product_Category", "Item_Description")["top_words"]


@query("f13_general_categories")
def f13_general_categories(spark, d):
    return profile.bar_data(table(spark, d, "documents"), "lang", "text")["general_categories"]


@query("w1_top_k")
def w1_top_k(spark, d):
    return rnd(profile.top_k(fx.invoice_lines(spark, d).select("Inv_Id", "Inv_Amt"), "Inv_Amt", 10, "Inv_Id"))


@query("k3_predicted_distribution")
def k3_predicted_distribution(spark, d):
    return profile.value_counts(fx.fake_predictions(spark, d), "y_pred", 10)


# ---------------------------------------------------------------------------------------------------
# J / I6: evaluation of prediction tables


def _preds(spark, d):
    return fx.fake_predictions(spark, d)


@query("j1_accuracy")
def j1_accuracy(spark, d):
    return rnd(evaluate.accuracy(_preds(spark, d)))


@query("j2_f1")
def j2_f1(spark, d):
    return rnd(evaluate.f1_scores(_preds(spark, d)))


@query("j3_classification_report")
def j3_classification_report(spark, d):
    return rnd(evaluate.classification_report(_preds(spark, d)))


@query("j5_confusion_matrix")
def j5_confusion_matrix(spark, d):
    return evaluate.confusion_matrix(_preds(spark, d))


@query("j6_log_loss")
def j6_log_loss(spark, d):
    """Cross-entropy of softmax(embedding) against each vector's label."""
    e = arrays.softmax_frame(_logits(spark, d), "embedding", "prob").select("label", "prob")
    return rnd(evaluate.log_loss(e, "prob", "label"))


def _second_model(spark, d):
    p = _preds(spark, d)
    num = F.regexp_extract("y_true", r"(\d+)$", 1).cast("int")
    moved = F.concat(F.lit("CLASS-"), (F.lit(1200) + (num - 1200 + 1) % 36).cast("string"))
    h = F.md5("Inv_Id")
    return p.select("Inv_Id", "y_true",
                    F.when(h.startswith("0") | h.startswith("1"), moved).otherwise(F.col("y_true")).alias("y_pred"))


def _results(spark, d):
    return evaluate.compare_models([
        evaluate.model_summary("model_a", 1, _preds(spark, d), params={"moved": "md5 0"}),
        evaluate.model_summary("model_b", 2, _second_model(spark, d), params={"moved": "md5 0-1"}),
    ])


@query("j4_compare_models")
def j4_compare_models(spark, d):
    return rnd(_results(spark, d))


@query("i6_select_best")
def i6_select_best(spark, d):
    return rnd(evaluate.select_best(_results(spark, d)))


# ---------------------------------------------------------------------------------------------------
# A: projections behind the sinks


@query("a8_submission")
def a8_submission(spark, d):
    from .sources.writers import submission
    return submission(_preds(spark, d).withColumnRenamed("y_pred", "Predicted_Category"))


@query("a9_export_categorized")
def a9_export_categorized(spark, d):
    from .sources.writers import categorized
    lines = fx.invoice_lines(spark, d)
    return rnd(categorized(lines.withColumn("General_Category", text.general_category("Item_Description"))))


@query("f4_value_counts_gl")
def f4_value_counts_gl(spark, d):
    return profile.value_counts(_lines_nulls(spark, d), "GL_Code", 5)


@query("f4_value_counts_class_top10")
def f4_value_counts_class_top10(spark, d):
    return profile.value_counts(fx.invoice_lines(spark, d), "Product_Category", 10)


@query("j5_confusion_pivot")
def j5_confusion_pivot(spark, d):
    """J5 for display: counts per (true class, predicted class), every predicted class a column."""
    preds = _preds(spark, d)
    labels = evaluate.class_labels(preds)
    p = evaluate.confusion_pivot(preds, labels)
    # The 36 classes of the views; a class that no line has is a column of zeros.
    cols = [f"CLASS-{1200 + i}" for i in range(36)]
    return p.select("y_true", *[(F.col(f"`{c}`") if c in labels else F.lit(0).cast("long")).alias(c.replace("-", "_"))
                                for c in cols])


from . import registry_images, registry_io, registry_models  # noqa: E402, F401 - they register their queries above

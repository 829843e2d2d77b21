"""Registered queries of fitted features, models and scoring.

Every model is fitted once per session and input folder with its real settings
and shared by the queries that need it. The classifiers of lines and documents are fitted on all training rows; those of
orders and embeddings on at most ``MODEL_ROWS`` labelled rows (the smallest hashes of the key). Features,
vocabularies, dictionaries and scores cover all rows. What a model must satisfy whatever its weights are
(known labels, confidence, order, sums, better than guessing) is part of each
result, so that SQL can check it.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fixtures as fx
from .functions import docs, text
from .operators import encode
from .operators.split import random_split, smallest
from .plans import score, train
from .plans.features import text_to_features
from .plans.preprocess import FeaturePipeline, TextBranch, fit_split, prepare_test, prepare_train
from .registry import query, rnd
from .session import cut_lineage, spread, stored, table

FIT_ROWS = None  # a bound on the training lines of the logistic regression and the forest: none, they take all
MODEL_ROWS = 4000  # labelled rows that the models of orders and embeddings are fitted on, at most
TINY = 1e-9

_FITTED: dict = {}


def fitted(spark, d: str, name: str, make):
    """``make()`` once per Spark application, input folder and name; what other folders left is let go."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _FITTED:
        for old in [k for k in _FITTED if k[:2] != key[:2]]:
            del _FITTED[old]
        _FITTED[key] = make()
    return _FITTED[key]


def bounded(df: DataFrame, key: str, n: int | None = FIT_ROWS) -> DataFrame:
    """At most ``n`` rows, those with the smallest hashes of the key; all rows without a bound."""
    return df if n is None else smallest(df, key, n, 7)


def parted(spark, d):
    """(feature model, all labelled lines with ``is_val``, class dictionary); vectors are made of the lines that need them."""
    def make():
        model, split = fit_split(fx.invoice_lines(spark, d), FeaturePipeline(), 0.2, 42)
        return model, split, model.class_dict
    return fitted(spark, d, "parted", make)


def _vectors(model, lines):
    return stored(model.transform(lines).select("Inv_Id", "Product_Category", "is_val", "label", "features"))


def prepared(spark, d):
    """(feature model, stored features with ``is_val``, class dictionary) of all labelled lines."""
    model, lines, classes = parted(spark, d)
    return model, fitted(spark, d, "prepared", lambda: _vectors(model, lines)), classes


def validation(spark, d):
    """(feature model, stored features, class dictionary) of the validation lines."""
    model, lines, classes = parted(spark, d)
    return model, fitted(spark, d, "validation", lambda: _vectors(model, lines.where("is_val"))), classes


def training(spark, d):
    """Vectors of the training lines (all lines that are not held out), which classifiers are fitted on."""
    model, lines, _ = parted(spark, d)
    return fitted(spark, d, "training", lambda: _vectors(model, bounded(lines.where(~F.col("is_val")), "Inv_Id")))


def logistic(spark, d):
    return fitted(spark, d, "logistic", lambda: train.train_logistic(spread(training(spark, d)), max_iter=1000, checkpoint=False))


def forest(spark, d):
    return fitted(spark, d, "forest", lambda: train.train_forest(
        spread(training(spark, d)), n_trees=100, max_depth=20, checkpoint=False))


def _known(classes: DataFrame, label):
    """Whether a label is one of the fitted classes (a scalar subquery of one array)."""
    return F.array_contains(classes.agg(F.collect_set("value")).scalar(), label)


def _checked(scored: DataFrame, classes: DataFrame, *keep: str) -> DataFrame:
    """What must hold for every scored row (``probabilities`` kept)."""
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)
    return scored.select(
        *keep, _known(classes, F.col("Predicted_Category")).alias("label_known"),
        (F.abs(F.col("Confidence") - F.array_max("probabilities")) < TINY).alias("confidence_is_max"),
        (F.abs(total - 1) < 1e-6).alias("sums_to_one"), F.size("probabilities").alias("n_classes"))


def _validated(spark, d, model) -> DataFrame:
    _, feats, classes = validation(spark, d)
    val = score.scored(feats, model, classes, keep_probabilities=True)
    hits = val.agg(F.avg((F.col("Predicted_Category") == F.col("Product_Category")).cast("double"))).scalar()
    share = val.groupBy("Product_Category").count().agg(F.max("count") / F.sum("count")).scalar()
    out = _checked(val, classes, "Inv_Id", "Product_Category")
    return out.withColumn("beats_majority", hits > share)


@query("g9_preprocess_features")
def g9_preprocess_features(spark, d):
    """Every non-zero entry of every line's fitted feature vector."""
    _, feats, _ = prepared(spark, d)
    return rnd(encode.vector_entries(feats, "features", ["Inv_Id", "is_val"]))


@query("g10_prepare_train")
def g10_prepare_train(spark, d):
    """Side of the split and class index of every line."""
    _, feats, _ = prepared(spark, d)
    return feats.select("Inv_Id", "is_val", "label")


@query("g10_fit_on_train")
def g10_fit_on_train(spark, d):
    """G10 without leaks: vocabulary, dictionaries and scaler from the training rows alone, every line's vector entries."""
    feats = fitted(spark, d, "fit_on_train", lambda: cut_lineage(prepare_train(
        fx.invoice_lines(spark, d), FeaturePipeline(), 0.2, 42, fit_on="train")[1].select("Inv_Id", "is_val", "features")))
    return rnd(encode.vector_entries(feats, "features", ["Inv_Id", "is_val"]))


@query("g11_prepare_test")
def g11_prepare_test(spark, d):
    """A pipeline fitted without the last suppliers, applied to all lines with nulls and unseen vendors."""
    fit, _ = fx.lines_unseen(spark, d)
    model = fitted(spark, d, "unseen", lambda: FeaturePipeline().fit(fit))
    test = prepare_test(fx.invoice_lines_nulls(spark, d).drop("Product_Category"), model)
    return rnd(encode.vector_entries(test, "features", ["Inv_Id"]))


@query("i1_train_logistic")
def i1_train_logistic(spark, d):
    """Logistic regression (1,000 iterations) scored on the validation lines."""
    return _validated(spark, d, logistic(spark, d))


@query("i1_recomputed")
def i1_recomputed(spark, d):
    """Each validation line's class probabilities from its vector entries and the fitted weights, joined and summed in SQL."""
    model, (_, feats, classes) = logistic(spark, d), validation(spark, d)
    feats = feats.withColumn("_row", F.monotonically_increasing_id())
    feats = cut_lineage(feats.select("_row", "Inv_Id", "features"))
    weights = model.coefficientMatrix.toArray().T.tolist()  # features by classes: bounded by the vocabulary
    table = F.broadcast(spark.createDataFrame(list(enumerate(weights)), "idx int, w array<double>"))
    k = len(model.interceptVector)
    per = encode.vector_entries(feats, "features", ["_row"]).join(table, "idx").groupBy("_row").agg(
        *[F.sum(F.col("weight") * F.col("w")[i]).alias(f"z{i}") for i in range(k)])
    logits = F.array(*[F.coalesce(F.col(f"z{i}"), F.lit(0.0)) + F.lit(float(b)) for i, b in enumerate(model.interceptVector)])
    own = feats.join(per, "_row", "left").withColumn("z", logits).select("_row", "Inv_Id", "features", "z")
    soft = F.transform("z", lambda x: F.exp(x - F.array_max("z")))
    own = own.withColumn("e", soft).withColumn("p", F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda a, y: a + y)))
    got = score.scored(own.select("_row", "Inv_Id", "features", "p"), model, classes, keep_probabilities=True)
    near = F.forall(F.zip_with("p", "probabilities", lambda a, b: F.abs(a - b) < 1e-6), lambda ok: ok)
    best = F.abs(F.array_max("p") - F.col("Confidence")) < 1e-6
    return got.select("Inv_Id", near.alias("same_probabilities"), best.alias("confidence_is_max"))


@query("i2_train_forest")
def i2_train_forest(spark, d):
    """100 trees of depth 20, scored on the validation lines."""
    return _validated(spark, d, forest(spark, d))


@query("i3_top_importances")
def i3_top_importances(spark, d):
    """The ten largest importances of the forest with their names."""
    model, _, _ = parted(spark, d)
    names = spark.createDataFrame(train.feature_names(model.vocabulary), "idx int, name string")
    top = train.top_importances(forest(spark, d), names, 10)
    ranked = top.agg(F.sort_array(F.collect_list(F.struct("importance", "idx", "name")), False).alias("t"))  # ten rows
    rows = ranked.select(F.posexplode("t").alias("pos", "x"), "t")
    return rows.select(
        (F.col("pos") + 1).alias("rank"), F.col("x.name").isNotNull().alias("name_known"),
        (F.col("x.importance") > 0).alias("positive"),
        ((F.col("pos") == 0) | (F.col("x.importance") <= F.get("t", F.col("pos") - 1)["importance"])).alias("in_order"))


def _doc_branches(spark, d):
    """documents -> text branch (TF-IDF vector), numeric branch (length, words), label = language index."""
    docs_t = table(spark, d, "documents").select("doc_id", "text", "lang")
    n = docs_t.agg(F.count(F.lit(1))).scalar()
    vocab = encode.fit_vocabulary(encode.term_stats(docs_t, "text", 2), n, 5000, 2, 0.95)
    terms, idf = encode.vocabulary_rows(vocab)  # <= 5,000 rows
    x = encode.add_tfidf(docs_t, "text", terms, idf, "text_vec")
    x = x.withColumn("numeric_vec", F.array(F.log1p(text.text_length("text").cast("double")),
                                            F.log1p(text.word_count("text").cast("double"))))
    langs = encode.fit_dictionary(docs_t, "lang")
    x = encode.encode_lookup(x, "lang", langs, "label").withColumn("label", F.col("label").cast("double"))
    x = random_split(x.select("doc_id", "lang", "label", "text_vec", "numeric_vec"), "doc_id", 0.2, 42)
    return cut_lineage(x), langs


@query("i4_train_fused")
def i4_train_fused(spark, d):
    """I4: text (5,000 terms) + numeric branches of the documents -> language, perceptron 256-128."""
    def make():
        x, langs = fitted(spark, d, "doc_branches", lambda: _doc_branches(spark, d))
        return x, langs, train.train_fused(x.where(~F.col("is_val")), text_col="text_vec", numeric_col="numeric_vec", max_iter=100)
    x, langs, fused = fitted(spark, d, "fused", make)
    val = score.scored(x.where("is_val"), fused, langs, keep_probabilities=True)
    return _checked(val, langs, "doc_id", "lang")


def _same_forward(x: DataFrame, fused, keep) -> DataFrame:
    """Whether the model's probabilities are those that its weights give for the assembled branches."""
    own = fused.classify(fused.assemble(x)).select(*keep, vector_to_array("_fused", "float32").alias("x"),
                                                   vector_to_array("probability").alias("p"), "prediction")
    layers = list(fused.model.getLayers())
    again = score.score_with(own, train.forward(fused.model.weights.toArray().tolist(), layers), "x", n_outputs=layers[-1],
                             out="q", input_dim=layers[0])
    near = F.forall(F.zip_with("p", "q", lambda a, b: F.abs(a - b) < 1e-4), lambda ok: ok)
    return again.select(*keep, "prediction", near.alias("same_forward"))


def _three_branches(spark, d):
    """Documents with text and numeric branches, joined by id with the embeddings (null where a document has none).

    The class is language, whether the document has more than 400 words, and the sign of its vector's first component: each
    branch holds a part of it that the others do not.
    """
    x, langs = fitted(spark, d, "doc_branches", lambda: _doc_branches(spark, d))
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    j = train.join_branches(x.withColumnRenamed("label", "lang_idx"), "doc_id", e)
    wide = F.coalesce((F.get("embedding", F.lit(0)) > 0).cast("int"), F.lit(0))
    long = (F.get("numeric_vec", F.lit(1)) > F.log1p(F.lit(400.0))).cast("int")
    return j.withColumn("label", F.col("lang_idx") * 4 + long * 2 + wide), langs


@query("i4_three_branches")
def i4_three_branches(spark, d):
    """I4: text, numeric and embedding branches in one model, joined by key; right on most held-out documents."""
    def make():
        x, _ = _three_branches(spark, d)
        x = cut_lineage(x)
        rows = x.where(~F.col("is_val") & F.col("embedding").isNotNull())
        return x, train.train_fused(rows, text_col="text_vec", numeric_col="numeric_vec", embedding_col="embedding", max_iter=150,
                                    n_classes=16, scale_numeric=True)
    x, fused = fitted(spark, d, "three_branches", make)
    got = _same_forward(x.withColumn("no_vector", F.col("embedding").isNull()), fused, ["doc_id", "lang", "label", "is_val", "no_vector"])
    got = cut_lineage(got)
    hits = got.where(F.col("is_val") & ~F.col("no_vector")).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).scalar()
    return got.select("doc_id", "lang", F.col("label").cast("int").alias("class"), "no_vector", "same_forward",
                      (hits > 0.6).alias("mostly_right"))


def _embedding_rows(spark, d):
    e = fx.image_branch(spark, d).withColumn("label", F.col("label").cast("double"))
    return fitted(spark, d, "embeddings", lambda: cut_lineage(random_split(e, "vec_id", 0.2, 42)))


@query("i5_train_embedding_only")
def i5_train_embedding_only(spark, d):
    """Embedding -> 256 -> label over the image branch."""
    e = _embedding_rows(spark, d)
    fused = fitted(spark, d, "embedding_only", lambda: train.train_embedding_only(
        bounded(e.where(~F.col("is_val")), "vec_id", MODEL_ROWS), max_iter=100))
    val = score.scored(e.where("is_val"), fused, None, keep_probabilities=True)
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)
    return val.select("vec_id", F.col("label").cast("int").alias("label"),
                      (F.abs(F.col("Confidence") - F.array_max("probabilities")) < TINY).alias("confidence_is_max"),
                      (F.abs(total - 1) < 1e-6).alias("sums_to_one"),
                      F.col("Predicted_Category").rlike(r"^CLASS-\d+$").alias("label_known"))


@query("j7_training_history")
def j7_training_history(spark, d):
    """Training loss, validation loss, accuracy and F1 of each of 20 epochs over the image branch."""
    def make():
        e = _embedding_rows(spark, d).withColumn("v", array_to_vector("embedding"))
        k = int(e.agg(F.max("label")).first()[0]) + 1
        dim = e.agg(F.max(F.size("embedding"))).first()[0]
        rows = bounded(e.where(~F.col("is_val")), "vec_id", MODEL_ROWS).select("v", "label")
        return train.train_epochs(rows, e.where("is_val").select("v", "label"), "v", "label", [dim, 256, k])[1]
    hist = fitted(spark, d, "history", make)
    h = spark.createDataFrame(hist, "epoch int, train_loss double, val_loss double, val_accuracy double, val_f1 double")
    last = h.agg(F.max_by("train_loss", "epoch")).scalar()
    first = h.agg(F.min_by("train_loss", "epoch")).scalar()
    return h.select("epoch", (F.col("val_loss") > 0).alias("val_loss_positive"),
                    F.col("val_accuracy").between(0, 1).alias("accuracy_in_range"),
                    F.col("val_f1").between(0, 1).alias("f1_in_range"), (last < first).alias("train_loss_falls"))


def _lines_without_class(spark, d):
    return fx.invoice_lines_nulls(spark, d).drop("Product_Category")


@query("k1_predict_batch")
def k1_predict_batch(spark, d):
    """K1: class and confidence of every line of the table with nulls, its columns filled."""
    model, _, classes = parted(spark, d)
    out = score.predict_batch(_lines_without_class(spark, d), model, logistic(spark, d))
    return rnd(out.select("Inv_Id", "Vendor_Code", "GL_Code", "Inv_Amt", "Item_Description",
                          _known(classes, F.col("Predicted_Category")).alias("label_known"),
                          F.col("Confidence").between(1 / 36 - TINY, 1 + TINY).alias("confidence_in_range")))


@query("k2_predict_top3")
def k2_predict_top3(spark, d):
    """K2: the three best classes of every line."""
    model, _, classes = parted(spark, d)
    out = score.predict_top3(fx.invoice_lines(spark, d).drop("Product_Category"), model, logistic(spark, d))
    top = out.select("Inv_Id", "Confidence", "Predicted_Category", "Top_Predictions",
                     F.posexplode_outer("Top_Predictions").alias("pos", "x"))  # outer: see b12_numeric_vector
    before = F.get("Top_Predictions", F.col("pos") - 1)["prob"]
    return top.select(
        "Inv_Id", (F.col("pos") + 1).alias("rank"), _known(classes, F.col("x.label")).alias("label_known"),
        ((F.col("pos") == 0) | (F.col("x.prob") <= before)).alias("in_order"),
        ((F.col("pos") > 0) | ((F.col("x.prob") == F.col("Confidence")) & (F.col("x.label") == F.col("Predicted_Category"))))
        .alias("first_is_prediction"))


def _order_status_model(spark, d):
    """A fused model over JSON-document features predicting the order status (F/O/P)."""
    def make():
        f = docs.feature_table(fx.invoice_docs(spark, d), keep=("file_name", "o_orderkey"))
        f = f.withColumn("numeric_features", docs.numeric_vector(f))
        status = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
        classes = encode.fit_dictionary(status, "o_orderstatus")
        lab = encode.encode_lookup(f.join(status, "o_orderkey"), "o_orderstatus", classes, "label")
        # Read twice below: all documents would be made again, with the tables that are broadcast for them.
        lab = cut_lineage(lab.select("o_orderkey", "numeric_features", F.col("label").cast("double").alias("label")))
        return train.train_fused(bounded(lab, "o_orderkey", MODEL_ROWS), numeric_col="numeric_features", max_iter=100), classes
    return fitted(spark, d, "order_status", make)


@query("k4_predict_from_json")
def k4_predict_from_json(spark, d):
    """K4: JSON documents (broken ones too) -> class and confidence."""
    fused, classes = _order_status_model(spark, d)
    out = score.predict_from_json(fx.invoice_docs_broken(spark, d), fused, class_dict=classes)
    return out.select("file_name", "num_items", _known(classes, F.col("Predicted_Category")).alias("label_known"),
                      F.col("Confidence").between(1 / 3 - TINY, 1 + TINY).alias("confidence_in_range"))


@query("k5_predict_from_text")
def k5_predict_from_text(spark, d):
    """K5: invoice text -> class, confidence and the document as JSON (read back here)."""
    fused, classes = _order_status_model(spark, d)
    out = score.predict_from_text(fx.invoice_text(spark, d), fused, classes, keep=("o_orderkey",), return_document=True)
    return out.select("o_orderkey", F.get_json_object("json_data", "$.invoice.invoice_number").alias("invoice_number"),
                      F.get_json_object("json_data", "$.subtotal.total").alias("total"),
                      _known(classes, F.col("Predicted_Category")).alias("label_known"),
                      F.col("Confidence").between(1 / 3 - TINY, 1 + TINY).alias("confidence_in_range"))


DOC_CLASSES = ["neither", "bolt", "ring", "bolt and ring"]


def _item_words(f: DataFrame) -> DataFrame:
    """Class index by the words that a document's items hold."""
    has = [F.array_contains(F.split("item_descriptions", " "), w).cast("int") for w in ("bolt", "ring")]
    return f.withColumn("label", (has[0] + 2 * has[1]).cast("double"))


def _document_model(spark, d, name: str, features):
    """(text branch, fused model of text and numbers, classes): which of two words a document's items hold."""
    def make():
        f = features()
        f = _item_words(f.withColumn("numeric_features", docs.numeric_vector(f)))
        f = cut_lineage(f.select("o_orderkey", "label", "combined_text", "numeric_features"))
        branch = TextBranch.fit(f, max_features=1000)
        rows = branch(bounded(f, "o_orderkey", MODEL_ROWS))
        fused = train.train_fused(rows, text_col="text_features", numeric_col="numeric_features", max_iter=100, n_classes=4,
                                  scale_numeric=True)
        return branch, fused, spark.createDataFrame(list(enumerate(DOC_CLASSES)), "idx int, value string")
    return fitted(spark, d, name, make)


def _json_model(spark, d):
    return _document_model(spark, d, "json_model", lambda: docs.feature_table(fx.invoice_docs(spark, d), keep=("file_name", "o_orderkey")))


def _text_scored(out: DataFrame, classes: DataFrame, *keep) -> DataFrame:
    """What a wrong text branch or model fails: entries of the text vector, unit length, most classes right."""
    u = F.unwrap_udt(F.col("text_features"))["values"]
    norm = F.aggregate(u, F.lit(0.0), lambda a, x: a + x * x)
    x = _item_words(out).select(*keep, F.size(F.filter(u, lambda w: w != 0)).alias("n_terms"),
                                ((F.abs(norm - 1) < 1e-9) | (norm == 0)).alias("unit_length"),
                                _known(classes, F.col("Predicted_Category")).alias("label_known"),
                                (F.col("Predicted_Category") == F.element_at(F.array(*map(F.lit, DOC_CLASSES)), F.col("label").cast("int") + 1))
                                .alias("_hit"))
    x = cut_lineage(x)
    return x.withColumn("mostly_right", x.agg(F.avg(F.col("_hit").cast("double"))).scalar() > 0.8).drop("_hit")


@query("k4_json_text_branch")
def k4_json_text_branch(spark, d):
    """K4 with a fitted text branch: JSON documents (broken ones too) -> text and numeric vectors -> class."""
    branch, fused, classes = _json_model(spark, d)
    out = score.predict_from_json(fx.invoice_docs_broken(spark, d), fused, text_model=branch, class_dict=classes)
    return _text_scored(out, classes, "file_name", "num_items")


@query("k5_text_branch")
def k5_text_branch(spark, d):
    """K5 with a fitted text branch: invoice text -> document -> text and numeric vectors -> class."""
    branch, fused, classes = _document_model(spark, d, "text_model", lambda: text_to_features(fx.invoice_text(spark, d), keep=("o_orderkey",)))
    out = score.predict_from_text(fx.invoice_text(spark, d), fused, classes, keep=("o_orderkey",), text_model=branch)
    return _text_scored(out, classes, "o_orderkey").withColumn("has_terms", F.col("n_terms") > 0).drop("n_terms")


@query("k4_same_forward")
def k4_same_forward(spark, d):
    """K4: probabilities of every document are those that the fitted weights give for its assembled branches."""
    branch, fused, _ = _json_model(spark, d)
    f = docs.feature_table(fx.invoice_docs_broken(spark, d), keep=("file_name",))
    f = branch(f.withColumn("numeric_features", docs.numeric_vector(f)))
    return _same_forward(f, fused, ["file_name"]).select("file_name", "same_forward")


def _linear_scores(weights, bias):
    """K6: the user's batch model is a fitted weight matrix."""
    def make():
        import numpy as np
        w, b = np.asarray(weights), np.asarray(bias)

        def predict(x):
            return (np.asarray(x, dtype=np.float64) @ w.T + b).astype(np.float32)
        return predict
    return make


@query("k6_score_with")
def k6_score_with(spark, d):
    """K6: a fitted weight matrix run as a batch model over every embedding, against the model's own prediction."""
    e = _embedding_rows(spark, d).withColumn("v", array_to_vector("embedding"))
    lr = fitted(spark, d, "embedding_logistic", lambda: train.train_logistic(
        bounded(e, "vec_id", MODEL_ROWS).select("v", "label"), features_col="v"))
    w, b = lr.coefficientMatrix.toArray().tolist(), lr.interceptVector.toArray().tolist()
    own = lr.transform(e).select("vec_id", "embedding", "prediction", vector_to_array("rawPrediction").alias("raw"))
    out = score.score_with(own, _linear_scores(w, b), "embedding", n_outputs=len(b), out="scores")
    near = F.forall(F.zip_with("scores", "raw", lambda x, y: F.abs(x - y) <= 1e-4 * (1 + F.abs(y))), lambda ok: ok)
    return out.select("vec_id", F.size("scores").alias("n_scores"), near.alias("same_scores"))



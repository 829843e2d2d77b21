"""Invoice-line preprocessing (B5, G8-G11): fill, clean, encode, scale, TF-IDF, assemble.

``FeaturePipeline.fit`` learns the fitted state as DataFrames and a few
scalars: vendor / GL / class dictionaries (distributed dense index), the
TF-IDF vocabulary with idf (at most ``max_features`` rows) and the amount
scaler. ``FeaturePipelineModel.transform`` turns any line table into a sparse
``features`` vector, row by row:

    term counts times idf, L2 norm (Arrow batches, see ``encode.add_tfidf``)
    -> VectorAssembler(tfidf, vendor_idx, gl_idx, amount_scaled)

Vendor and GL codes enter as plain numbers (index, unknown -> 0), as in the
reference; a StringIndexer would mark them categorical and trip maxBins.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import encode
from ..session import cut_lineage, spread, stored

# Defaults for missing line fields.
LINE_DEFAULTS = {
    "Item_Description": "",
    "Vendor_Code": "VENDOR-UNKNOWN",
    "GL_Code": "GL-UNKNOWN",
    "Inv_Amt": 0.0,
}


def fill_defaults(df: DataFrame) -> DataFrame:
    """Fill nulls of the four line fields with their defaults (a projection)."""
    present = {k: v for k, v in LINE_DEFAULTS.items() if k in df.columns}
    return df.fillna(present)


class NotFittedError(ValueError):
    pass


@dataclass
class FeaturePipelineModel:
    """Fitted preprocessing state (G9). Dictionaries stay DataFrames; vocabulary and idf are small."""

    vocabulary: list[str]
    idf: list[float]
    vendor_dict: DataFrame
    gl_dict: DataFrame
    class_dict: DataFrame | None
    amount_mean: float
    amount_std: float
    dict_bytes: dict = field(default_factory=dict)
    settings: dict = field(default_factory=dict)  # text_col, id_col, label_col, split and vocabulary settings

    # -- transform -----------------------------------------------------------------------------------

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill, encode, scale, vectorise. Unknown codes -> index 0."""
        label = self.settings.get("label_col", "Product_Category")
        x = fill_defaults(df)
        x = encode.add_tfidf(x, self.settings.get("text_col", "Item_Description"), self.vocabulary, self.idf, "tfidf")
        x = encode.transform_dictionary(x, "Vendor_Code", self.vendor_dict, "vendor_idx",
                                        size=self.dict_bytes.get("vendor"))
        x = encode.transform_dictionary(x, "GL_Code", self.gl_dict, "gl_idx", size=self.dict_bytes.get("gl"))
        scaler = encode.Scaler(self.amount_mean, self.amount_std)
        x = x.withColumn("amount_scaled", scaler.transform("Inv_Amt"))
        if self.class_dict is not None and label in x.columns:
            x = encode.encode_lookup(x, label, self.class_dict, "label", size=self.dict_bytes.get("class"))
            x = x.withColumn("label", F.col("label").cast("double"))
        return VectorAssembler(inputCols=["tfidf", "vendor_idx", "gl_idx", "amount_scaled"], outputCol="features").transform(x)

    @property
    def n_features(self) -> int:
        return len(self.vocabulary) + 3

    # -- persistence (A10) ----------------------------------------------------------------------------

    def save(self, path: str) -> None:
        """A10: dictionaries to Parquet, vocabulary/idf/scaler/settings to one JSON document."""
        spark = self.vendor_dict.sparkSession
        self.vendor_dict.write.mode("overwrite").parquet(f"{path}/vendor_dict")
        self.gl_dict.write.mode("overwrite").parquet(f"{path}/gl_dict")
        if self.class_dict is not None:
            self.class_dict.write.mode("overwrite").parquet(f"{path}/class_dict")
        meta = {
            "vocabulary": self.vocabulary, "idf": self.idf, "amount_mean": self.amount_mean,
            "amount_std": self.amount_std, "dict_bytes": self.dict_bytes, "settings": self.settings,
            "has_class_dict": self.class_dict is not None,
        }
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
            f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeaturePipelineModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        class_dict = spark.read.parquet(f"{path}/class_dict") if meta["has_class_dict"] else None
        return cls(
            vocabulary=meta["vocabulary"], idf=meta["idf"],
            vendor_dict=spark.read.parquet(f"{path}/vendor_dict"),
            gl_dict=spark.read.parquet(f"{path}/gl_dict"),
            class_dict=class_dict, amount_mean=meta["amount_mean"], amount_std=meta["amount_std"],
            dict_bytes=meta["dict_bytes"], settings=meta["settings"],
        )


@dataclass
class FeaturePipeline:
    """G9/G10 fit side. Defaults follow the reference: 5000 terms, 1-2-grams, min_df 2, max_df 0.95."""

    max_features: int = 5000
    min_df: int = 2
    max_df: float = 0.95
    text_col: str = "Item_Description"
    id_col: str = "Inv_Id"
    test_size: float = 0.2
    seed: int = 42

    def fit(self, df: DataFrame, label_col: str | None = "Product_Category", materialise: bool = True) -> FeaturePipelineModel:
        """Fit dictionaries, vocabulary and scaler on ``df`` (after filling defaults).

        Three passes: term counts, distinct codes of all dictionaries, and one
        aggregate for row count, mean and deviation. They read a checkpoint of the columns they need, so the plan behind
        ``df`` runs once; switch ``materialise`` off where ``df`` is a stored table already.
        """
        x = fill_defaults(df)
        if materialise:
            needed = [self.text_col, "Inv_Amt", "Vendor_Code", "GL_Code", label_col]
            x = spread(cut_lineage(x.select(*[c for c in dict.fromkeys(needed) if c in x.columns])))
        row = x.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("Inv_Amt").cast("double")).alias("m"),
                    F.stddev_pop(F.col("Inv_Amt").cast("double")).alias("s"), encode.text_bytes(self.text_col).alias("b")).first()
        stats = encode.term_stats(x, self.text_col, 2, size=row["b"] or 0)
        vocab = encode.fit_vocabulary(stats, row["n"], self.max_features, self.min_df, self.max_df)
        terms, idf = encode.vocabulary_rows(vocab)  # <= max_features rows
        labelled = bool(label_col and label_col in x.columns)
        cols = ["Vendor_Code", "GL_Code", *([label_col] if labelled else [])]
        dicts = encode.fit_dictionaries(x, cols)
        parts = {n: encode.dictionary_of(dicts, c) for n, c in zip(("vendor", "gl", "class"), cols)}
        sizes = {r["column_name"]: int(r["b"]) for r in dicts.groupBy("column_name").agg(
            F.sum(F.octet_length("value") + encode._ENTRY_BYTES).alias("b")).collect()}  # one row per column
        return FeaturePipelineModel(
            vocabulary=terms, idf=idf, vendor_dict=parts["vendor"], gl_dict=parts["gl"],
            class_dict=parts.get("class"), amount_mean=float(row["m"] or 0.0), amount_std=float(row["s"] or 0.0),
            dict_bytes={n: sizes.get(c, 0) for n, c in zip(("vendor", "gl", "class"), cols)},
            settings={"max_features": self.max_features, "min_df": self.min_df, "max_df": self.max_df,
                      "text_col": self.text_col, "id_col": self.id_col, "label_col": label_col,
                      "test_size": self.test_size, "seed": self.seed, "spark_version": df.sparkSession.version},
        )


@dataclass
class TextBranch:
    """A fitted TF-IDF vectoriser of one text column, for models that score documents (K4, K5, I4)."""

    vocabulary: list[str]
    idf: list[float]
    text_col: str = "combined_text"
    out: str = "text_features"

    @classmethod
    def fit(cls, df: DataFrame, text_col: str = "combined_text", out: str = "text_features", max_features: int = 5000,
            min_df: int = 2, max_df: float = 0.95) -> TextBranch:
        """Learn the 1-2-gram vocabulary and idf of ``text_col``; nulls count as empty texts."""
        n = df.agg(F.count(F.lit(1))).scalar()
        vocab = encode.fit_vocabulary(encode.term_stats(df, text_col, 2), n, max_features, min_df, max_df)
        terms, idf = encode.vocabulary_rows(vocab)  # <= max_features rows
        return cls(terms, idf, text_col, out)

    def __call__(self, df: DataFrame) -> DataFrame:
        """``df`` with the sparse vector ``out``; unknown terms are left out."""
        return encode.add_tfidf(df, self.text_col, self.vocabulary, self.idf, self.out)

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {"vocabulary": self.vocabulary, "idf": self.idf, "text_col": self.text_col, "out": self.out}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextBranch:
        return cls(**json.loads(spark.read.text(path, wholetext=True).first()[0]))


def fit_split(df: DataFrame, pipeline: FeaturePipeline | None = None, test_size: float | None = None,
              seed: int | None = None, label_col: str = "Product_Category", fit_on: str = "all"):
    """G10 up to the vectors: (fitted model, filled rows with ``is_val``). The input's plan runs once: its stored rows are split
    and fitted on. The vectors of any of the rows are ``model.transform`` of them."""
    from ..operators.split import stratified_split

    pipeline = pipeline or FeaturePipeline()
    if test_size is not None or seed is not None:
        pipeline = replace(pipeline, test_size=pipeline.test_size if test_size is None else test_size,
                           seed=pipeline.seed if seed is None else seed)
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', not {fit_on!r}")
    x = spread(stored(fill_defaults(df)))
    split = stratified_split(x, label_col, pipeline.id_col, pipeline.test_size, pipeline.seed)
    if fit_on == "train":
        split = cut_lineage(split)
        return pipeline.fit(split.where(~F.col("is_val")), label_col, materialise=False), split
    return pipeline.fit(x, label_col, materialise=False), split


def prepare_train(df: DataFrame, pipeline: FeaturePipeline | None = None, test_size: float | None = None,
                  seed: int | None = None, label_col: str = "Product_Category", fit_on: str = "all"):
    """Fill, fit (on all rows by default, as the reference; ``fit_on='train'`` fits on training rows only),
    encode the class, split (H1). The input's plan runs once: its checkpoint is split, fitted on and transformed.
    Returns (model, features with ``is_val``, class dictionary)."""
    model, split = fit_split(df, pipeline, test_size, seed, label_col, fit_on)
    return model, model.transform(split), model.class_dict


def prepare_test(df: DataFrame, model: FeaturePipelineModel | None) -> DataFrame:
    """Transform unlabelled lines with a fitted model; error when not fitted."""
    if model is None:
        raise NotFittedError("the preprocessing pipeline must be fitted on training data first")
    return model.transform(df)

"""Encoders and lookups.

Fitted state is always a DataFrame (dictionary, vocabulary) or a handful of
scalars (scaler). Dictionaries are joined; their bytes are measured first and
decide whether they are broadcast. A vocabulary reaches the driver only when it
is capped by ``max_features``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import add_terms
from ..session import cut_lineage
from .ranking import dense_index, row_number_within
from .terms import term_counter, vectoriser

# Dictionaries of up to this many bytes are broadcast to the lookup side.
BROADCAST_BYTES = 64 << 20
_ENTRY_BYTES = 48  # a row's cost besides its text
_TASK_BYTES = 16 << 20  # the terms of this much text are summed up by one task


def dictionary_bytes(dictionary: DataFrame) -> int:
    """Bytes that a fitted dictionary takes when broadcast (one aggregate over its checkpoint)."""
    r = dictionary.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("b")).first()
    return int(r["n"]) * _ENTRY_BYTES + int(r["b"] or 0)


def _lookup(df: DataFrame, dictionary: DataFrame, on: str, how: str, size: int | None) -> DataFrame:
    """Equi-join against a dictionary of ``size`` bytes; not broadcast beyond the bound.

    Then both sides are shuffled on the code and AQE splits the partitions of hot
    codes (a plain sort-merge join, which its skew handling can split).
    """
    d = F.broadcast(dictionary) if size is not None and size <= BROADCAST_BYTES else dictionary
    return df.join(d, on=on, how=how)


def _size(dictionary: DataFrame, size: int | None) -> int:
    return dictionary_bytes(dictionary) if size is None else size


# -- G1 / G2 / E3 / E4 / E5 -------------------------------------------------------------------------


def fit_dictionary(df: DataFrame, col: str) -> DataFrame:
    """G1: sorted distinct non-null values -> (value, idx 0..n-1). Distributed (no single-task sort).

    The dictionary is checkpointed, so later uses (its size, lookups) never fit again.
    """
    return cut_lineage(dense_index(df, col, out="idx").withColumnRenamed(col, "value"))


def fit_dictionaries(df: DataFrame, cols) -> DataFrame:
    """G1 for several columns in one pass: (column_name, value, idx), checkpointed."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
    distinct = df.select(F.explode(pairs).alias("p")).select("p.*").where("value IS NOT NULL").distinct()
    ranked = row_number_within(distinct, ["column_name"], ["value"], out="idx")
    return cut_lineage(ranked.select("column_name", "value", F.col("idx").cast("int").alias("idx")))


def dictionary_of(dictionaries: DataFrame, col: str) -> DataFrame:
    """One column's (value, idx) out of ``fit_dictionaries``."""
    return dictionaries.where(F.col("column_name") == col).select("value", "idx")


def encode_lookup(df: DataFrame, col: str, dictionary: DataFrame, out: str, size: int | None = None) -> DataFrame:
    """Value -> index through a fitted dictionary; unknown values get null."""
    d = dictionary.select(F.col("value").alias(col), F.col("idx").alias(out))
    return _lookup(df, d, col, "left", _size(dictionary, size))


def transform_dictionary(df: DataFrame, col: str, dictionary: DataFrame, out: str, unknown: int = 0,
                         size: int | None = None) -> DataFrame:
    """Known value -> its index; unknown (or null) -> ``unknown`` (index 0, the first class, by default)."""
    j = encode_lookup(df, col, dictionary, "_idx", size)
    return j.withColumn(out, F.coalesce(F.col("_idx"), F.lit(unknown)).cast("double")).drop("_idx")


def decode_labels(df: DataFrame, idx_col: str, dictionary: DataFrame | None, out: str, prefix: str = "CLASS-",
                  size: int | None = None) -> DataFrame:
    """Index -> label via the class dictionary; without one, ``prefix`` + index."""
    if dictionary is None:
        return df.withColumn(out, F.concat(F.lit(prefix), F.col(idx_col).cast("int").cast("string")))
    d = dictionary.select(F.col("idx").cast("int").alias("_i"), F.col("value").alias(out))
    j = _lookup(df.withColumn("_i", F.col(idx_col).cast("int")), d, "_i", "left", _size(dictionary, size))
    return j.drop("_i")


def known_values(df: DataFrame, col: str, dictionary: DataFrame, size: int | None = None) -> DataFrame:
    """E5: rows whose value is in the fitted set (left semi join)."""
    return _lookup(df, dictionary.select(F.col("value").alias(col)), col, "left_semi",
                   _size(dictionary, size))


def unseen_values(df: DataFrame, col: str, dictionary: DataFrame, size: int | None = None) -> DataFrame:
    """E5: rows whose value is not in the fitted set (left anti join; null values count as unseen)."""
    return _lookup(df, dictionary.select(F.col("value").alias(col)), col, "left_anti",
                   _size(dictionary, size))


# -- G3 ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Scaler:
    """G3 fitted state: population mean and std (std 0 -> 1)."""

    mean: float
    std: float

    def transform(self, c) -> Column:
        c = F.col(c) if isinstance(c, str) else c
        return (c.cast("double") - F.lit(self.mean)) / F.lit(self.std if self.std != 0 else 1.0)


def fit_scaler(df: DataFrame, col: str) -> Scaler:
    """Mean and population std of a column (two scalars reach the driver)."""
    row = df.agg(F.avg(F.col(col).cast("double")).alias("m"), F.stddev_pop(F.col(col).cast("double")).alias("s")).first()
    return Scaler(float(row["m"] or 0.0), float(row["s"] or 0.0))


def scale_column(df: DataFrame, col: str) -> Column:
    """G3 as one plan: (x - mean) / std with mean and std as scalar subqueries (no collect)."""
    x = F.col(col).cast("double")
    m = df.agg(F.avg(x)).scalar()
    s = df.agg(F.stddev_pop(x)).scalar()
    return (x - m) / F.when(s == 0, F.lit(1.0)).otherwise(s)


# -- G4-G7 -------------------------------------------------------------------------------------------


def text_bytes(text_col: str) -> Column:
    """Aggregate: bytes of all texts."""
    return F.sum(F.octet_length(F.col(text_col).cast("string")))


def _filled(text_col: str) -> Column:
    """The text, null as ''. Tasks lower its case as they find its words (``lower`` takes longer than finding them)."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def term_stats(df: DataFrame, text_col: str, n_max: int = 2, size: int | None = None) -> DataFrame:
    """G5 counted: (term, count, df) of every 1..n_max-gram: corpus count and rows that hold it.

    Each row contributes its terms once for the count and its distinct terms once
    for df, so rows are never regrouped: no shuffle on text or row, and repeated ids
    count as rows of their own. Without ``size`` (see ``text_bytes``) ``df`` is read once more for it: hand in a stored table.
    """
    # Batches of rows are counted by themselves, so one shuffle on terms follows and its tasks grow in number, not in size:
    # a partial aggregate of a whole task's terms would hold them all.
    size = df.agg(text_bytes(text_col)).first()[0] or 0 if size is None else size
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-size // _TASK_BYTES))
    rows = df.select(_filled(text_col).alias("t")).mapInArrow(term_counter(n_max), "term string, n long, d long")
    return rows.repartition(tasks, "term").groupBy("term").agg(F.sum("n").alias("count"), F.sum("d").alias("df"))


def fit_vocabulary(stats: DataFrame, n_docs, max_features: int | None = 5000, min_df: int = 2,
                   max_df: float = 0.95) -> DataFrame:
    """(term, idx, df, idf) from ``term_stats``.

    Keep terms with df >= min_df and df <= max_df * n_docs; of those the
    ``max_features`` with the highest corpus count (ties: term ascending);
    index alphabetically. idf = ln((1 + n) / (1 + df)) + 1 (smoothed).
    ``n_docs`` is a number or a scalar Column (e.g. ``docs.agg(count).scalar()``).
    Without a cap the index comes from a distributed rank.
    """
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    kept = stats.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(float(max_df)) * n))
    idf = F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    if not max_features:
        ranked = row_number_within(kept.withColumn("idf", idf), [], ["term"], out="idx")
        return ranked.select("term", F.col("idx").cast("int").alias("idx"), "df", "idf")
    kept = kept.orderBy(F.desc("count"), F.asc("term")).limit(max_features)
    # At most max_features rows: a global window here is bounded.
    idx = F.row_number().over(Window.orderBy("term")) - 1
    return kept.select("term", idx.cast("int").alias("idx"), "df", idf.alias("idf"))


def vocabulary_rows(vocab: DataFrame) -> tuple[list[str], list[float]]:
    """Terms and idf of a capped vocabulary in index order (at most ``max_features`` rows)."""
    rows = vocab.orderBy("idx").select("term", "idf").collect()
    return [r["term"] for r in rows], [float(r["idf"]) for r in rows]


def tfidf_stages(terms: list[str], idf: list[float], in_col: str, out_col: str) -> list:
    """Row-wise stages over term arrays: term counts, times idf, L2 norm (sparse vectors; no shuffle, no Python)."""
    return [CountVectorizerModel.from_vocabulary(terms, inputCol=in_col, outputCol="_tf"),
            ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_tfidf_raw"),
            Normalizer(p=2.0, inputCol="_tfidf_raw", outputCol=out_col)]


def add_tfidf(df: DataFrame, text_col: str, terms: list[str], idf: list[float], out: str, n_max: int = 2) -> DataFrame:
    """``df`` with the sparse vector ``out``: the vectors of ``tfidf_stages`` straight from text, by Arrow batches (no shuffle)."""
    v = F.arrow_udf(vectoriser(terms, idf, n_max), VectorUDT())(_filled(text_col))
    # With its size stated, assembling the vector looks at no row (and works on streams).
    return df.withColumn(out, v.alias(out, metadata={"ml_attr": {"num_attrs": len(terms)}}))


def vector_entries(df: DataFrame, vector_col: str, keep) -> DataFrame:
    """(keep..., idx, weight): the non-zero entries of a vector column (sparse or dense, never made dense)."""
    x = df.select(*keep, F.unwrap_udt(F.col(vector_col)).alias("_u"))
    at = F.coalesce(F.col("_u.indices"), F.sequence(F.lit(0), F.size("_u.values") - 1))
    pairs = F.arrays_zip(at.alias("idx"), F.col("_u.values").alias("weight"))
    # explode_outer for the same reason as in ``term_stats``; rows without entries go with the zeros.
    return x.select(*keep, F.explode_outer(pairs).alias("_e")).select(
        *keep, F.col("_e.idx").alias("idx"), F.col("_e.weight").alias("weight")).where("weight <> 0")


def tfidf(df: DataFrame, id_col: str, text_col: str, vocab: DataFrame, max_features: int | None = 5000,
          n_max: int = 2) -> DataFrame:
    """(id, term, idx, weight) with weight = tf * idf, L2-normalised per row.

    A capped vocabulary runs row by row: one tokenisation, no shuffle at all. An
    uncapped one (of any size) is joined on the term instead, and terms are grouped by row.
    """
    if max_features:
        vocab = cut_lineage(vocab)
        terms, idf = vocabulary_rows(vocab)
        x = add_terms(df.select(id_col, text_col), text_col, "_terms", n_max).select(id_col, "_terms")
        x = PipelineModel(stages=tfidf_stages(terms, idf, "_terms", "_v")).transform(x)
        return vector_entries(x, "_v", [id_col]).join(F.broadcast(vocab.select("term", "idx")), "idx").select(
            id_col, "term", "idx", "weight")
    rows = add_terms(cut_lineage(df.select(id_col, text_col).withColumn("_row", F.monotonically_increasing_id())),
                     text_col, "_terms", n_max)
    tf = (rows.select("_row", id_col, F.explode_outer("_terms").alias("term")).where(F.col("term").isNotNull())
          .groupBy("_row", id_col, "term").agg(F.count(F.lit(1)).alias("tf")))
    w = F.col("tf") * F.col("idf")
    j = tf.join(vocab.select("term", "idx", "idf"), "term")
    norm = F.sqrt(F.sum(w * w).over(Window.partitionBy("_row")))
    return j.select(id_col, "term", "idx", (w / norm).alias("weight"))

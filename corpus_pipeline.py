"""Corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet below the shared checkpoint folder and hands what it
reads back to the next. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, mixing, quality, simhash, toxicity
from ledgerlens.llm.common import read_table, staged
from ledgerlens.llm.queries import GOOD_AT, TOXIC_AT, fit_quality, fit_toxicity, labelled_domains, rank_path

# Bits, word positions and models have no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.reject(docs, model, TOXIC_AT)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = fit_quality(docs, read_table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.reject(docs, model, GOOD_AT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints stays: the one with the smallest id.

    Of repeated rows of that id one stays. Rows without an id stay only in groups without any id.
    """
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated by their rates; targets flatten languages and sources; every rate is 1 or more."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id")
    rates, _, _, _ = mixing.mix(docs, labelled_domains(docs, labels), least=1.0)
    return mixing.apply_rates(docs, rates)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and slice starts of every row, as little-endian unsigned 32-bit integers; the ids must decode to the text."""
    rows = docs.select("doc_id", "source", "lang", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
    # Encoded and decoded by the same worker: two workers at once would hold the tables twice.
    back = bpe.encode(rows, rank_path(), keep=("doc_id", "source", "lang", "text_sha256"), digest="decoded_sha256")
    lost = F.raise_error(F.concat(F.lit("ids do not decode to the text of document "),
                                  F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))).cast("string")
    return back.select("doc_id", "source", "lang", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", "piece_starts",
                       F.when(F.col("decoded_sha256") == F.col("text_sha256"), F.col("decoded_sha256")).otherwise(lost)
                       .alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = staged(out, instead_of=docs) if i < len(STAGES) - 1 else out
    return docs

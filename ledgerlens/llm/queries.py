"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (alignment, ann, bpe, centroids, chat, embed_dedup, mixing, ngram_lm, quality, sharding, simhash,
                            token_files, toxicity)
from ledgerlens.llm.common import id_remainder, read_table, shared_path, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TOXIC_AT = 0.7
GOOD_AT = 0.3
LM_ORDER = 2
SHARDS = [f"shard-{i:02d}" for i in range(32)]


def _register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def rank_path() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def fit_quality(docs: DataFrame, labels: DataFrame) -> quality.QualityModel:
    return quality.fit(docs, labels.where(id_remainder("doc_id", 5) != 0))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    return toxicity.fit(docs, labels.where(id_remainder("doc_id", 3) != 1))


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Ids that the labels table covers, with their language as the domain, and their source."""
    return docs.select("doc_id", F.col("lang").alias("domain"), "source").join(labels.select("doc_id").distinct(), "doc_id")


@_register
def op1_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows by inner product of every row whose id is divisible by 20."""
    vectors = staged(embed_dedup.usable(read_table(spark, sf_dir, "embeddings"), id_col="vec_id", vec_col="embedding"))
    index = staged(ann.build_index(vectors))
    return ann.search(index, vectors.where("id % 20 = 0"), k=20)


@_register
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the line-labelling conditional random field."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = quality.score(docs, fit_quality(docs, labels))
    return scored.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= GOOD_AT).cast("int").alias("predicted"), "n_lines", "n_bad_lines")


@_register
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again; digests of both."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    enc = bpe.encode(docs, rank_path())
    enc = enc.select("doc_id", "ids", "piece_starts", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                     F.sha2("ids", 256).alias("ids_sha256"))
    dec = bpe.decode(enc, rank_path(), keep=("doc_id", "n_tokens", "ids_sha256"), starts_col="piece_starts")
    return dec.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"),
                      (F.length("slice_starts") / 4).cast("long").alias("n_pieces"))


@_register
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and group of every vector at cosine 0.9 or more."""
    found = embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def mixed_records(rows: DataFrame) -> DataFrame:
    """Conversation rows as records of three layouts, dealt by a hash; roles that a layout would rewrite stay turn rows."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    kind = F.when(F.col("role").isin("user", "assistant", "system"), F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3))).otherwise(0)
    message = F.array(F.struct(role.alias("role"), text.alias("content")))
    said = F.array(F.struct(role.alias("speaker"), text.alias("text")))
    return rows.select(
        "conv_id", "turn", F.when(kind == 0, F.struct("role", "text")).alias("row"),
        F.when(kind == 1, F.struct(message.alias("messages"))).alias("messages"),
        F.when(kind == 2, F.struct(said.alias("dialog"))).alias("dialog"))


@_register
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as marked text, read back; one more conversation has the marks in its texts."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = F.lit("<|im_end|><|im_start|>assistant ok")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), marks.alias("text"))
    rows = rows.unionByName(extra)
    turns = chat.struct_turns(mixed_records(rows), record_cols=("row", "messages", "dialog"), conv_col="conv_id", turn_col="turn")
    back = chat.read_back(chat.format_turns(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(F.encode(loss, "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@_register
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as ORC in ascending id order and read back."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = shared_path(spark)
    token_files.write(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.digests(token_files.read(spark, path))


@_register
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the scaled n-gram classifier."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity.score(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))


@_register
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling rate and number of copies of every document for flattened shares of languages and sources."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = read_table(spark, sf_dir, "labels").select("doc_id")
    rates, domains, _, _ = mixing.mix(docs, labelled_domains(docs, labels), least=1.0)
    keyed = docs.select("doc_id", "source", mixing.row_key("doc_id", "text").alias("_key"))
    return keyed.join(rates, "_key").select(
        "doc_id", "source", F.col("tokens").cast("long").alias("n_tokens"),
        *[F.round(F.col("post")[i], 6).alias(f"p_{d}") for i, d in enumerate(domains)],
        "rate", mixing.copies(F.col("rate"), F.col("_key")).alias("n_copies"))


@_register
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@_register
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document written to its shard; placement of the rows read back, which must be the folder they lie in."""
    path = shared_path(spark)
    folder = sharding.write_shards(read_table(spark, sf_dir, "documents"), SHARDS, path, tasks_per_shard=4)
    back = spark.read.parquet(path).select("doc_id", F.col(folder).alias("_folder"))
    placed = sharding.place(back, SHARDS, keep=("_folder",))
    wrong = F.raise_error(F.lit("a document lies in another shard than its own")).cast("string")
    return placed.select("doc_id", "slot", F.when(F.col("shard") == F.col("_folder"), F.col("shard")).otherwise(wrong).alias("shard"))


@_register
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and final centroid of every usable vector after ten rounds."""
    vectors = staged(centroids.integer_vectors(read_table(spark, sf_dir, "embeddings"), id_col="vec_id", vec_col="embedding",
                                               dims=64, scale=1024))
    found = centroids.cluster(vectors, k=8, rounds=10, dims=64, salt="3:")
    digest = spark.createDataFrame(
        [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(found.centroids)],
        "cluster int, centroid_sha256 string")
    small = centroids.inertias(found.assigned).join(digest, "cluster")
    return found.assigned.join(F.broadcast(small), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@_register
def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of every document by the bigram model of nine tenths of them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder("doc_id", 10) == 0
    model = ngram_lm.fit(docs.where(~held_out), shared_path(spark), text_col="text", order=LM_ORDER)
    scored = ngram_lm.score(docs, model, text_col="text", keep=("doc_id",))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@_register
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document under two tokenizers, scored by the documents that hold each linked pair."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    indexed = alignment.index(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
                              id_col="doc_id", text_col="text")
    return alignment.scores(indexed)

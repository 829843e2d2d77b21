"""The pipeline against its stages done by hand, and the SQL of the queries that have it."""

import base64
import hashlib
import os

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ledgerlens.llm import mixing, quality, queries, toxicity
from ledgerlens.session import TABLES
from tests.llm.test_simhash import brute_fingerprint, brute_groups
from tools.oracle_check import _rows

SQL_NAMES = ("op4_embedding_near_dedup", "op5_chat_format", "op10_sharding", "op13_centroid_clustering")


@pytest.mark.parametrize("name", SQL_NAMES)
def test_query_matches_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = entry.queries()[name](spark, sf)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(cols, cur.fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_stages_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    # Stage by stage: the models are the operators', what follows from their scores is done by hand.
    tox = queries.fit_toxicity(docs, labels.select("doc_id", "toxic"))
    left = [i for i in sorted(rows) if toxicity.score_texts(tox, [rows[i].text])[0] < queries.TOXIC_AT]
    one = corpus_pipeline.drop_toxic(spark, docs, sf)
    assert one.schema.names == docs.schema.names and sorted(r.doc_id for r in one.collect()) == left

    qual = queries.fit_quality(one, labels.select("doc_id", "quality"))
    left = [i for i in left if quality.score_texts(qual, [rows[i].text])[0][0] >= queries.GOOD_AT]
    two = corpus_pipeline.keep_quality(spark, one, sf)
    assert sorted(r.doc_id for r in two.collect()) == left

    prints = [(i, brute_fingerprint(rows[i].text)) for i in left]
    left = sorted(set(brute_groups(prints)))
    three = corpus_pipeline.drop_near_duplicates(spark, two, sf)
    assert sorted(r.doc_id for r in three.collect()) == left and three.schema.names == docs.schema.names

    rates, _, _, _ = mixing.mix(three, queries.labelled_domains(three, labels.select("doc_id")), least=1.0)
    rate = {r._key: r.rate for r in rates.collect()}
    keys = {r.doc_id: r.k for r in three.select("doc_id", mixing.row_key("doc_id", "text").alias("k")).collect()}
    n = {r.k: r.n for r in three.select(mixing.row_key("doc_id", "text").alias("k")).join(
        rates, F.col("k") == F.col("_key")).select("k", mixing.copies(F.col("rate"), F.col("k")).alias("n")).collect()}
    want = sorted(i for i in left for _ in range(n[keys[i]]))
    assert all(rate[k] >= 1 and n[k] in (int(rate[k]), int(rate[k]) + 1) for k in n)
    four = corpus_pipeline.mix_sources(spark, three, sf)
    assert sorted(r.doc_id for r in four.collect()) == want

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == want
    for r in got:
        ids = lib.encode_ordinary(rows[r.doc_id].text)
        assert bytes(r.ids) == np.array(ids, "<u4").tobytes() and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].text.encode()).hexdigest()


def test_stages_take_edge_rows_and_empty_tables(spark, sf, docs):
    for table in (docs, docs.limit(0)):
        df = table
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, sf)
        assert df.count() >= 0

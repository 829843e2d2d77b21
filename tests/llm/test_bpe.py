"""Byte-level BPE against the tiktoken library, and its round trip."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, queries

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def merger():
    with open(PATH, "rb") as f:
        return bpe.Merger(f.read())


def test_random_texts_match_the_library(library, merger):
    rnd = random.Random(5)
    parts = ["'", "s", "t", "re", "ve", "m", "ll", "d", " ", "  ", "\n", "\t", " ", "　", "é", "A", "1", "²", "!", "#",
             "日", "'s", "'ll", " 's", "'re", "x" * 60, "!!!" * 30, "\x1c", "́", "Ⅷ", "😀"]
    for _ in range(60):
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(50)]
        for t, (ids, _) in zip(texts, merger.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t), t


def test_piece_starts_cut_the_text_into_slices(library, merger):
    text = "It's  12 o'clock,\n\nisn't it?  "
    ids, starts = next(merger.encode([text]))
    at = [*np.frombuffer(starts, "<u4").tolist(), len(text)]
    pieces = [text[a:b] for a, b in zip(at, at[1:])]
    assert "".join(pieces) == text
    assert [i for p in pieces for i in np.frombuffer(next(merger.encode([p]))[0], "<u4").tolist()] != []
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)


def test_edge_rows_round_trip(spark, docs, library):
    enc = bpe.encode(docs, PATH, keep=("doc_id", "lang"))
    rows = bpe.decode(enc, PATH, keep=("doc_id",)).collect()
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    assert sorted((r.doc_id or -1, bytes(r.decoded)) for r in rows) == sorted((i or -1, t) for i, t in texts)
    got = {(r.doc_id, bytes(r.ids)) for r in enc.collect()}
    for r in docs.collect():
        assert (r.doc_id, np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes()) in got


def test_empty_table_and_clashing_columns(spark, docs):
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    clash = docs.withColumn("ids", F.lit(1)).withColumn("_x", F.lit("y"))
    assert bpe.encode(clash, PATH).columns == ["doc_id", "ids", "piece_starts"]


def test_query_matches_the_library(spark, sf, library):
    rows = {r.doc_id: r for r in queries.op3_byte_bpe(spark, sf).collect()}
    src = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(src)
    for d in src:
        ids = library.encode_ordinary(d.text or "")
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_offsets_cut_the_decoded_text_into_the_slices(spark, docs, library):
    import regex

    enc = bpe.encode(docs, PATH)
    for r in bpe.decode(enc, PATH, keep=("doc_id", "ids"), starts_col="piece_starts").collect():
        at = np.frombuffer(r.slice_starts, "<u4").tolist()
        parts = [bytes(r.decoded)[a:b].decode() for a, b in zip(at, [*at[1:], len(r.decoded)])]
        assert parts == regex.findall(P.PATTERN, bytes(r.decoded).decode())
        assert [i for p in parts for i in library.encode_ordinary(p)] == np.frombuffer(r.ids, "<u4").tolist()
    moved = enc.where("doc_id = 1").withColumn("piece_starts", F.encode(F.lit("\x01\x00\x00\x00\x02\x00\x00\x00"), "UTF-8"))
    with pytest.raises(Exception, match="begins inside a token"):
        bpe.decode(moved, PATH, starts_col="piece_starts").collect()


def test_digest_is_of_the_decoded_ids(spark, docs):
    got = bpe.encode(docs, PATH, keep=("doc_id", "text"), digest="own_sha256")
    assert got.columns == ["doc_id", "text", "ids", "piece_starts", "own_sha256"]
    assert all(r.own_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() for r in got.collect())

"""Cross-tokenizer alignment against whole-text encoding and plain loops."""

import hashlib
import json
from bisect import bisect
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from ledgerlens.llm import alignment
from ledgerlens.llm.common import read_table
from ledgerlens.llm.queries import op11_token_alignment
from pyspark.sql import functions as F
from tokenizers import Tokenizer

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", " a", "a ", " ", "  ", "\n", "two  spaces   here ", "tab\tand\nline\r\n  end", "don't we'll '  's", "x" * 3000 + " end", "ab" * 2000,
       "nbsp  x 　 y  z", "\x1c a\x1f b", "<|endoftext|> <s> </s> <unk> <0x41>", "▁piece", "null \x00 byte", "Füße — “quoted” … ok",
       "日本語のテキスト 😀😀 👩‍👩‍👧", "1234567 12 3.14 ", "line\n\n\n  indented\n\tmore", "́ combining", "é ä", "﻿bom", "end  sep\u0085 x"]


def plain(rows):
    """Results by whole-text encoding: {row number: (doc_id, n_a, n_b, n_groups, links Counter, printed)}."""
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    out = []
    for doc, text in rows:
        none = (doc, 0, 0, 0, Counter(), "")
        if not text:
            out.append(none)
            continue
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ba = [alignment.byte_level(a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if not b"".join(ba) == b"".join(bb) == (" " + text).encode():
            out.append(none)
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        shown, links, pa_, pb_ = [], Counter(), 0, 0
        for e in sorted(set(ea) & set(eb)):
            qa, qb = bisect(ea, e), bisect(eb, e)
            ga, gb = ia[pa_:qa], ib[pb_:qb]
            shown.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            links.update((x, y) for x in ga for y in gb)
            pa_, pb_ = qa, qb
        out.append((doc, len(ia), len(ib), len(shown), links, ";".join(shown)))
    return out


def scored(rows):
    found = plain(rows)
    count = Counter(p for r in found for p in r[4])
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return sorted(str((r[0], r[1], r[2], r[3], sum(r[4].values()), sum(n for p, n in r[4].items() if count[p] == most[p[0]]),
                       sum(n * count[p] for p, n in r[4].items()), hashlib.sha256(r[5].encode()).hexdigest() if r[5] else "")) for r in found), count, found


def rows_of(df):
    return sorted(str((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)) for r in df.collect())


@pytest.mark.parametrize("limits", [(2 << 20, 2_000_000, 1 << 16, 32 << 20, 4_000_000), (3000, 500, 40, 5000, 7)])
def test_odd_texts_equal_whole_text_encoding(spark, limits, monkeypatch):
    for name, v in zip(("SLICE_BYTES", "BLOCK_LINKS", "BLOCK_DOCS", "SHARD_BYTES", "EXPAND"), limits, strict=True):
        monkeypatch.setattr(alignment, name, v)
    rows = [(i, t) for i, t in enumerate(ODD * 3)] + [(None, "no id a"), (1, " a"), (1, " a"), (70, None), (71, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_a", F.lit("clash")).repartition(3)
    want, count, found = scored(rows)
    indexed = alignment.index(df, A_PATH, B_PATH, id_col="doc_id", text_col="text")
    assert rows_of(alignment.scores(indexed)) == want
    links = Counter()
    for r in found:
        links.update(r[4])
    assert {(r.a, r.b): (r.n_docs, r.n_links) for r in alignment.pair_links(indexed).collect()} == {p: (count[p], links[p]) for p in count}


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in read_table(spark, sf, "documents").collect()]
    assert rows_of(op11_token_alignment(spark, sf)) == scored(rows)[0]


def test_postings_round_trip():
    rng = np.random.default_rng(1)
    for n_docs in (1, 9, 4000):
        sizes = np.array([1, n_docs, max(1, n_docs // 3), 1])
        docs = np.concatenate([np.sort(rng.choice(n_docs, s, replace=False)) for s in sizes])
        links = rng.integers(1, 1 << 20, len(docs))
        at, many = alignment.unpack_postings(alignment.pack_postings(sizes, docs, links, n_docs), sizes)
        assert (at == docs).all() and (many == links).all()


def test_chunks_join_to_the_texts():
    codes, first, entries = alignment.chunks(pa.array([*ODD, None, ""]))
    parts = entries.to_pylist()
    for i, t in enumerate([*ODD, "", ""]):
        assert b"".join(parts[c] for c in codes[first[i]:first[i + 1]]).decode() == " " + t


def test_other_tokenizer_files_go_to_the_library():
    with open(A_PATH, encoding="utf-8") as fa, open(B_PATH, "rb") as fb:
        a_json, b_model = fa.read(), fb.read()
    spec = json.loads(a_json)
    assert len(alignment._merge_ranks(spec)) == 50_256
    assert alignment._merge_ranks({**spec, "normalizer": {"type": "Lowercase"}}) is None
    swapped = {**spec, "model": {**spec["model"], "merges": spec["model"]["merges"][::-1]}}
    assert alignment._merge_ranks(swapped) is None
    one, two = alignment.Pair(a_json, b_model), alignment.Pair(a_json, b_model)
    two.fast = None
    _, _, entries = alignment.chunks(pa.array(ODD))
    for x, y in zip(one.encode(entries), two.encode(entries), strict=True):
        assert all((p == q).all() for p, q in zip(x, y, strict=True))


def test_empty_table(spark, docs):
    indexed = alignment.index(docs.limit(0), A_PATH, B_PATH, id_col="doc_id", text_col="text")
    assert alignment.scores(indexed).collect() == []

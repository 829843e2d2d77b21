"""The n-gram model against a plain dictionary version, and its edge cases."""

import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from ledgerlens.llm import ngram_lm
from ledgerlens.llm.common import id_remainder, read_table
from ledgerlens.llm.words import split_words
from pyspark.sql import functions as F


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), " end"]


class Plain:
    """Interpolated modified Kneser-Ney with dictionaries."""

    def __init__(self, texts, order):
        self.order, self.counts = order, {}
        top = Counter()
        for t in texts:
            seq = ["<s>"] * (order - 1) + tokens(t)
            top.update(tuple(seq[i:i + order]) for i in range(len(seq) - order + 1))
        self.words = len({g[-1] for g in top})
        for k in range(order, 0, -1):
            self.counts[k] = top
            top = Counter(g[1:] for g in top)
        self.d, self.total, self.n = {}, {}, {}
        for k, c in self.counts.items():
            of = Counter(c.values())
            y = of[1] / (of[1] + 2 * of[2]) if of[1] else 0
            d = [i - (i + 1) * y * of[i + 1] / of[i] if of[i] else 0 for i in (1, 2, 3)]
            self.d[k] = [0, *(x if 0 < x < i else i / 2 for i, x in zip((1, 2, 3), d))]
            self.total[k], self.n[k] = Counter(), defaultdict(Counter)
            for g, n in c.items():
                self.total[k][g[:-1]] += n
                self.n[k][g[:-1]][min(n, 3)] += 1

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / (self.words + 1)
        lower, ctx = self.p(gram[1:]), gram[:-1]
        if not self.total[k][ctx]:
            return lower
        c = self.counts[k][gram]
        gamma = sum(self.d[k][i] * n for i, n in self.n[k][ctx].items())
        return (max(c - self.d[k][min(c, 3)], 0) + gamma * lower) / self.total[k][ctx]

    def score(self, text):
        seq = ["<s>"] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(tuple(seq[i:i + self.order]))) for i in range(len(seq) - self.order + 1))


def test_split_words_like_the_pattern():
    texts = ["A b", None, "", " \n", "x", "Füße\x85ÄB\x0b\x1cq ", "end", "e\tnd"]
    got = split_words(pa.array(texts), lower=True)
    words = [w.decode() for w in got.entries.to_pylist()]
    for i, t in enumerate(texts):
        assert [words[c] for c in got.codes[got.starts[i]:got.starts[i + 1]]] == tokens(t)[:-1]
    sliced = split_words(pa.array(texts).slice(4, 3), lower=False)
    assert [w.decode() for w in sliced.entries.to_pylist()] == ["x", "Füße\x85ÄB", "\x1cq", "end"]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_a_plain_version(spark, sf, tmp, order, monkeypatch):
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 100_000)  # several shards
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    out = id_remainder("doc_id", 10) == 0
    model = ngram_lm.fit(docs.where(~out), f"{tmp}/m", text_col="text", order=order)
    assert model.bits > 1
    got = ngram_lm.score(docs, model, text_col="text", keep=("doc_id",)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    learn = [texts[r.doc_id] for r in docs.where(~out).collect()]
    plain, counts = Plain(learn, order), Counter(itertools.chain.from_iterable(map(tokens, learn)))
    n, v = sum(counts.values()), len(counts)
    assert (model.tokens, model.words) == (n, v) and len(got) == len(texts)
    for r in got:
        seq = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known) == (len(seq), sum(t in counts for t in seq))
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in seq), rel=1e-9)
        assert r.score == pytest.approx(plain.score(texts[r.doc_id]), rel=1e-6)
    if order > 1:
        row = ngram_lm.perplexity(spark.createDataFrame(got).where(out)).first()
        assert row.perplexity < row.base_perplexity


def test_probabilities_sum_to_one(spark, tmp):
    docs = spark.createDataFrame([("a b a c b b a d",), ("b a b d d a",), ("c a b",), ("a b",)], "text string")
    model = ngram_lm.fit(docs, f"{tmp}/m", text_col="text", order=3)
    words = ["a", "b", "c", "d", " end", "never seen"]
    hashes = np.array([ngram_lm.END if w == " end" else xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    ids, _ = ngram_lm._ids(model, hashes)
    assert model.words == 5
    start = model.words + 1
    for ctx in [(start, start), (start, ids[0]), (ids[0], ids[1]), (ids[3], ids[2]), (ids[5], ids[0]), (ids[5], ids[5])]:
        grams = [np.full(len(ids), c, np.uint64) for c in ctx]
        assert ngram_lm.probabilities(model, [*grams, ids]).sum() == pytest.approx(1.0, rel=1e-6)


def test_edge_rows(spark, docs, tmp):
    model = ngram_lm.fit(docs, f"{tmp}/m", text_col="text", order=2)
    wide = docs.withColumn("score_", F.lit(1)).withColumn("_text2", F.lit("x"))
    got = ngram_lm.score(wide, model, text_col="text", keep=("doc_id", "_text2")).collect()
    assert len(got) == docs.count() and got[0].__fields__[:2] == ["doc_id", "_text2"]
    by = {}
    for r in got:
        assert by.setdefault(r.doc_id, r.score) == r.score and r.score < 0  # repeated rows score alike
    assert {r.n_tokens for r in got if r.doc_id in (2, 3, 4)} == {1}
    assert next(r for r in got if r.doc_id == 7).n_tokens == 20_001


def test_empty_tables(spark, docs, tmp):
    none = ngram_lm.fit(docs.limit(0), f"{tmp}/m", text_col="text", order=2)
    got = ngram_lm.score(docs, none, text_col="text", keep=("doc_id",)).collect()
    assert all(r.score == 0 and r.n_known == 0 for r in got)
    assert ngram_lm.score(docs.limit(0), none, text_col="text", keep=("doc_id",)).collect() == []


def test_folder_must_be_mounted():
    assert ngram_lm.mounted("file:///a%20b/c") == "/a b/c"
    with pytest.raises(ValueError):
        ngram_lm.mounted("hdfs://host/x")

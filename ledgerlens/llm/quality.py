"""Quality: a linear-chain conditional random field marks every line good or bad.

A line's features are thresholded shares of its characters and words (letters,
upper case, symbols, bars, repeated words, copies of the line in its text, ...)
and the same of the lines before and after it. Node scores and a 2 x 2
transition table give, by forward-backward, each line's probability of being
good. Products of 2 x 2 matrices are associative, so both passes are doubling
scans over all lines of many texts at once; a text's first line resets the chain.
A document's quality is the length-weighted mean of its lines' probabilities,
turned into a probability of label 1 by a logistic curve fitted on the sample.

The model is fitted on a bounded sample (``SAMPLE`` labelled rows of each class at
most, of each the middle ``SAMPLE_LINES`` lines at most); a line of a sampled text carries its document's label. So
that the chain learns to change between good and bad within a text, each sampled text also enters with a block of
lines of a text of the other class put inside, each line with the label of the text it comes from.
Whole texts are read for scores. Null text counts as empty: one empty line. Repeated rows score alike.
Without labelled rows of both classes all texts score that share (0.5 without
any label). Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import codepoints, labelled_sample, sample_rows, slices, texts_of
from ledgerlens.llm.linear import log_loss, minimise, sigmoid

SAMPLE = 1500  # labelled rows of each class that the model is fitted on, at most
SAMPLE_LINES = 2000  # lines of a sampled text that the model is fitted on, at most
BLOCK_LINES = 12  # lines of another text put into a sampled one, at most
LEVELS = (0.01, 0.03, 0.08, 0.15, 0.3, 0.5, 0.8)
LENGTHS = (1, 20, 60, 150, 400, 1000, 4000)
# Character kinds.
LOWER, UPPER, DIGIT, BLANK, STOP, BAR, BANG, MARK, OTHER = range(9)
KINDS = 9
SHARES = 13
WIDTH = SHARES * len(LEVELS) + len(LENGTHS)
PENALTY = 1e-4
_SALT = np.random.default_rng(11).integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)


def _kind_table() -> np.ndarray:
    out = np.full(1 << 16, OTHER, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c.isspace():
            out[i] = BLANK
        elif c.isupper():
            out[i] = UPPER
        elif c.isalpha():
            out[i] = LOWER
        elif c.isdigit():
            out[i] = DIGIT
        elif c in ".,;:'\"()?-":
            out[i] = STOP
        elif c == "|":
            out[i] = BAR
        elif c == "!":
            out[i] = BANG
        elif 33 <= i < 127:
            out[i] = MARK
    return out


_KIND = _kind_table()


def _copies(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each entry how many entries of its group came before it with the same key."""
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
    first = np.flatnonzero(new)
    rank = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
    out = np.empty(len(g), np.int64)
    out[order] = rank
    return out


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own features as 0/1 float32 by line, length of each line, number of lines of each text)."""
    joined = "\n".join(texts)
    cp = codepoints(joined + "\n")
    brk = np.flatnonzero(cp == 10)
    begin = np.concatenate([[0], brk[:-1] + 1])
    length = brk - begin
    n = len(brk)
    lines = np.array([t.count("\n") + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts)), lines)
    line = np.repeat(np.arange(n), length + 1)
    kind = np.where(cp < 1 << 16, _KIND[np.minimum(cp, 0xFFFF)], OTHER)
    by_kind = np.bincount(line * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS).astype(np.float64)
    by_kind[:, BLANK] -= 1  # the line's end
    size = np.maximum(length, 1.0)
    # Words: runs without white space; a salted sum identifies each.
    word_char = kind != BLANK
    w0 = np.flatnonzero(word_char & np.concatenate([[True], ~word_char[:-1]]))
    w1 = np.flatnonzero(word_char & np.concatenate([~word_char[1:], [True]])) + 1
    feats = np.zeros((n, SHARES))
    letters = np.maximum(by_kind[:, LOWER] + by_kind[:, UPPER], 1.0)
    feats[:, 0] = by_kind[:, LOWER] / size
    feats[:, 1] = by_kind[:, UPPER] / letters
    for i, k in enumerate((DIGIT, BLANK, STOP, BAR, BANG, MARK, OTHER), 2):
        feats[:, i] = by_kind[:, k] / size
    # Copies of whole lines within their text, the later ones marked.
    at = np.arange(len(cp)) - np.repeat(begin, length + 1)
    salted = (cp.astype(np.uint64) + np.uint64(7)) * _SALT[at & 4095]
    salted ^= salted >> np.uint64(29)
    line_key = np.add.reduceat(salted, begin)
    feats[:, 9] = (_copies(doc, line_key) > 0) & (length > 0)
    if len(w0):
        wl = line[w0]
        wpos = np.arange(len(cp)) - np.repeat(np.append(0, w0), np.diff(np.append(np.append(0, w0), len(cp))))
        salted = (cp.astype(np.uint64) + np.uint64(7)) * _SALT[wpos & 4095]
        salted ^= salted >> np.uint64(29)
        salted[~word_char] = 0
        key = np.add.reduceat(salted, w0)
        words = np.maximum(np.bincount(wl, minlength=n), 1.0)
        same = np.zeros(len(w0))
        same[1:] = (key[1:] == key[:-1]) & (wl[1:] == wl[:-1])
        feats[:, 10] = np.bincount(wl, weights=same, minlength=n) / words
        feats[:, 11] = np.bincount(wl, weights=_copies(wl, key) > 0, minlength=n) / words
        odd = np.isin(kind[w1 - 1], (MARK, BAR, BANG, OTHER))
        feats[:, 12] = np.bincount(wl, weights=odd, minlength=n) / words
    own = np.empty((n, WIDTH), np.float32)
    own[:, :SHARES * len(LEVELS)] = (feats[:, :, None] >= np.array(LEVELS)).reshape(n, -1)
    own[:, SHARES * len(LEVELS):] = length[:, None] >= np.array(LENGTHS)
    return own, length, lines


def _edges(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Booleans by line: first of its text, last of its text."""
    stop = np.cumsum(lines)
    first, last = np.zeros(int(stop[-1]), bool), np.zeros(int(stop[-1]), bool)
    first[stop - lines], last[stop - 1] = True, True
    return first, last


def _scan(mats: np.ndarray) -> np.ndarray:
    """Prefix products of 2 x 2 matrices by doubling, each scaled to a largest entry of one."""
    out, step = mats / mats.max(axis=(1, 2), keepdims=True), 1
    while step < len(out):
        a, b = out[:-step], out[step:]
        c = np.empty_like(b)
        for i in (0, 1):
            for j in (0, 1):
                c[:, i, j] = a[:, i, 0] * b[:, 0, j] + a[:, i, 1] * b[:, 1, j]
        c /= np.maximum(c.max(axis=(1, 2), keepdims=True), 1e-300)
        out[step:] = c
        step *= 2
    return out


def marginals(node: np.ndarray, trans: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(good) by line, summed pair marginals 2 x 2); ``node`` is the good state's score over the bad one's."""
    first, last = _edges(lines)
    pot = np.stack([np.exp(np.minimum(-node, 0.0)), np.exp(np.minimum(node, 0.0))], axis=1)
    t = np.exp(trans - trans.max())
    fwd = t[None] * pot[:, None, :]
    fwd[first] = pot[first][:, None, :]
    alpha = _scan(fwd)[:, 0, :]
    nxt = np.ones((len(node), 2, 2))
    nxt[:-1] = t[None] * pot[1:, None, :]
    nxt[last] = 1.0
    # Suffix products: reversed and transposed they are prefix products.
    beta = _scan(nxt[::-1].transpose(0, 2, 1))[::-1].transpose(0, 2, 1).sum(axis=2)
    both = alpha * beta
    p = both / np.maximum(both.sum(axis=1, keepdims=True), 1e-300)
    inner = np.flatnonzero(~last)
    pair = alpha[inner][:, :, None] * t[None] * (pot[inner + 1] * beta[inner + 1])[:, None, :]
    pair /= np.maximum(pair.sum(axis=(1, 2), keepdims=True), 1e-300)
    return p[:, 1], pair


@dataclass(frozen=True)
class QualityModel:
    """Weights for a line (own, previous, next, intercept), transitions, and the curve for documents."""

    weights: np.ndarray
    trans: np.ndarray
    slope: float
    bias: float


def _node(own: np.ndarray, lines: np.ndarray, weights: np.ndarray) -> np.ndarray:
    first, last = _edges(lines)
    w = weights[:-1].reshape(3, WIDTH).astype(np.float32)
    parts = own @ w.T
    z = parts[:, 0].astype(np.float64) + weights[-1]
    z[1:] += np.where(first[1:], 0.0, parts[:-1, 1])
    z[:-1] += np.where(last[:-1], 0.0, parts[1:, 2])
    return z


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def document_means(p: np.ndarray, length: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities for each text."""
    w = length + 1.0
    at = np.cumsum(lines) - lines
    return np.add.reduceat(p * w, at) / np.add.reduceat(w, at)


def mixed_chains(lines: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every text as it is and with a block of the other class inside: (line of each place, lines, labels of places, weights)."""
    rng = np.random.default_rng(5)
    start = np.cumsum(lines) - lines
    other = {c: np.flatnonzero(y != c) for c in (0.0, 1.0)}
    at, n, label, weight = [np.arange(int(lines.sum()))], [lines], [np.repeat(y, lines)], [w]
    for i in range(len(lines)):
        j = int(rng.choice(other[float(y[i])]))
        many = int(rng.integers(1, min(BLOCK_LINES, int(lines[j])) + 1))
        put = int(rng.integers(0, int(lines[i]) + 1))
        took = start[j] + int(rng.integers(0, int(lines[j]) - many + 1)) + np.arange(many)
        mine = start[i] + np.arange(int(lines[i]))
        at.append(np.concatenate([mine[:put], took, mine[put:]]))
        label.append(np.concatenate([np.full(put, y[i]), np.full(many, 1.0 - y[i]), np.full(len(mine) - put, y[i])]))
        n.append(np.array([len(mine) + many]))
        weight.append(w[i:i + 1])
    return tuple(np.concatenate(x) for x in (at, n, label, weight))


def fit_sample(own: np.ndarray, length: np.ndarray, lines: np.ndarray, y: np.ndarray, w: np.ndarray) -> QualityModel:
    """Maximum likelihood of the line labels with a small penalty, then the documents' curve."""
    flat = np.zeros(3 * WIDTH + 1)
    share = float((w * y).sum() / w.sum()) if len(y) else 0.5
    if not len(y) or not 0.0 < share < 1.0:
        return QualityModel(flat, np.zeros((2, 2)), 0.0, 30.0 * (2.0 * share - 1.0))
    place, chain, yl, wc = mixed_chains(lines, y, w)
    plain = (own, lines)
    own, lines = own[place], chain
    first, last = _edges(lines)
    # A chain counts once, however many lines it has.
    wl = np.repeat(wc / lines, lines)
    wl /= wl.sum()
    inner = np.flatnonzero(~last)
    yi = yl.astype(int)

    def gradient(x: np.ndarray) -> np.ndarray:
        """Of minus the weighted log-likelihood: marginals minus labels, for nodes and for pairs."""
        weights, trans = x[:-4], x[-4:].reshape(2, 2)
        z = _node(own, lines, weights)
        p, pair = marginals(z, trans, lines)
        e = wl * (p - yl)
        grad = np.empty_like(x)
        ef, el = e.copy(), e.copy()
        ef[first], el[last] = 0.0, 0.0
        grad[:WIDTH] = e @ own
        grad[WIDTH:2 * WIDTH] = ef[1:] @ own[:-1]
        grad[2 * WIDTH:3 * WIDTH] = el[:-1] @ own[1:]
        grad[3 * WIDTH] = e.sum()
        gt = (pair * wl[inner][:, None, None]).sum(axis=0)
        np.subtract.at(gt, (yi[inner], yi[inner + 1]), wl[inner])
        grad[-4:] = gt.ravel()
        grad += PENALTY * x
        return grad

    x = np.zeros(3 * WIDTH + 5)
    x[-4:] = (0.5, -0.5, -0.5, 0.5)
    m, v = np.zeros_like(x), np.zeros_like(x)
    for i in range(1, 121):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - 0.08 * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.99 ** i)) + 1e-8) * (1.0 if i < 80 else 0.3)
    weights, trans = x[:-4], x[-4:].reshape(2, 2)
    own, lines = plain
    q = _logit(document_means(marginals(_node(own, lines, weights), trans, lines)[0], length, lines))
    wn = w / w.sum()

    def curve(c: np.ndarray) -> tuple[float, np.ndarray]:
        z = c[0] * q + c[1]
        e = wn * (sigmoid(z) - y)
        return log_loss(z, y, wn) + 1e-3 * float(c @ c) / 2, np.array([e @ q, e.sum()]) + 1e-3 * c

    slope, bias = minimise(curve, np.array([0.5, 0.0]))
    return QualityModel(weights, trans, float(slope), float(bias))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = SAMPLE) -> QualityModel:
    """Fit on at most ``sample`` labelled rows of each class (``labels`` holds the rows that may be learnt from)."""
    rows = sample_rows(docs, id_col, text_col, labelled_sample(labels, id_col, label_col, sample))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                own, length, lines = line_features(texts_of(part, "_text"))
                bits = np.packbits(own.astype(bool), axis=1)
                spans = [(b - n + (n - m) // 2, b - n + (n - m) // 2 + m) for b, n, m in zip(
                    np.cumsum(lines).tolist(), lines.tolist(), np.minimum(lines, SAMPLE_LINES).tolist(), strict=True)]
                packed = [bits[a:b].tobytes() for a, b in spans]
                size = [length[a:b].astype("<i8").tobytes() for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(3)), pa.array(packed, pa.binary()), pa.array(size, pa.binary())],
                    names=["id", "y", "w", "bits", "size"])

    got = rows.select("_id", "_y", "_w", "_text").mapInArrow(
        features, f"id {rows.schema['_id'].dataType.simpleString()}, y int, w double, bits binary, size binary")
    got = got.toArrow().sort_by("id")
    y, w = got.column("y").to_numpy().astype(np.float64), got.column("w").to_numpy()
    size = [np.frombuffer(s, "<i8") for s in got.column("size").to_pylist()]
    lines = np.array([len(s) for s in size], np.int64)
    if not len(lines):
        return fit_sample(np.zeros((0, WIDTH), np.float32), np.zeros(0), lines, y, w)
    raw = np.frombuffer(b"".join(got.column("bits").to_pylist()), np.uint8).reshape(int(lines.sum()), -1)
    own = np.unpackbits(raw, axis=1)[:, :WIDTH].astype(np.float32)
    return fit_sample(own, np.concatenate(size), lines, y, w)


def label_lines(model: QualityModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(P(good) by line, line lengths, lines by text)."""
    own, length, lines = line_features(texts)
    return marginals(_node(own, lines, model.weights), model.trans, lines)[0], length, lines


def score_texts(model: QualityModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(score, lines more likely bad than good) of each text."""
    p, length, lines = label_lines(model, texts)
    at = np.cumsum(lines) - lines
    return (sigmoid(model.slope * _logit(document_means(p, length, lines)) + model.bias),
            np.add.reduceat((p < 0.5).astype(np.int64), at))


def score(docs: DataFrame, model: QualityModel, *, text_col: str = "text",
          keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: the kept columns, ``score``, ``n_lines`` and ``n_bad_lines``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few kilobytes
    src = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = docs.select(*keep).schema.add("score", "double").add("n_lines", "long").add("n_bad_lines", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = texts_of(part, "_text")
                s, bad = score_texts(shared.value, texts)
                n = np.array([t.count("\n") + 1 for t in texts], np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), pa.array(s), pa.array(n),
                                                  pa.array(bad)], names=[*keep, "score", "n_lines", "n_bad_lines"])

    return src.mapInArrow(run, schema)


def reject(docs: DataFrame, model: QualityModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose score is at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(score_texts(shared.value, texts_of(part, text_col))[0] >= threshold))

    return docs.mapInArrow(run, docs.schema)

"""Toxicity: character n-gram linear classifier with naive Bayes scaled features.

The character n-grams (n = 3, 4, 5) of the lower-cased text, white space runs as
one space, are hashed to 2^20 buckets. A bucket's feature is how often it occurs for the
text's length, saturating at 1, so that an ordinary n-gram met once in a long text counts
little. Its naive Bayes log-count ratio compares the summed features of toxic and
other sampled texts. The buckets whose features are most clearly higher in toxic
texts (by their t-statistic) are kept, scaled by their ratios, and weighed by a
logistic regression. All that is fitted on a bounded sample (``SAMPLE`` rows of
each class at most) of the labelled rows; scoring reads all rows and whole texts. So that a toxic passage
is not lost in a long text, the same weights also score every window of ``WINDOW`` characters (half overlapping) of a text
longer than two of them; the text's score is its highest.

Null text counts as empty; empty and very short texts score by the intercept.
Repeated rows score alike. Without labelled rows of both classes every text
scores that share (0.5 without any label). Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import codepoints, labelled_sample, sample_rows, slices, staged, texts_of
from ledgerlens.llm.linear import log_loss, minimise, sigmoid

SAMPLE = 1500  # labelled rows of each class that the model is fitted on, at most
ORDERS = (3, 4, 5)
BITS = 20
FEATURES = 5000  # buckets that the regression weighs (at most 65,536: slots travel as 16 bits)
SMOOTHING = 0.1  # added to a bucket's summed features in either class
UNIT = 65535  # features are summed as whole numbers of this part, so sums don't depend on their order
PER = 600  # characters for which an n-gram's occurrences are counted, about 100 words
WINDOW = 2000  # characters of a window of a long text
PENALTY = 0.02
_MIX = np.uint32(0x9E3779B1)
_BASE = np.uint32(0x01000193)


def _lower_table() -> np.ndarray:
    out = np.arange(1 << 16, dtype=np.uint32)
    for i in range(1 << 16):
        if not 0xD800 <= i < 0xE000:
            low = chr(i).lower()
            out[i] = ord(low) if len(low) == 1 else i
            if chr(i).isspace():
                out[i] = 32
    return out


_LOWER = _lower_table()


def _saturating(n: np.ndarray, size: int) -> np.ndarray:
    """Occurrences per ``PER`` characters, r, as r / (1 + r), in a text of ``size`` characters."""
    rate = n * (PER / max(size, 1))
    return rate / (1.0 + rate)


class Hasher:
    """Hashed n-grams of a text; the marks table finds the distinct ones in linear time, without sorting."""

    def __init__(self) -> None:
        self.marks = np.zeros(1 << BITS, np.int32)

    def grams(self, text: str) -> np.ndarray:
        """Buckets of all n-grams, repeats included."""
        return self._grams(text)[0]

    def _grams(self, text: str) -> tuple[np.ndarray, list[int]]:
        """(buckets of all n-grams, by n and place; their number for each n)."""
        cp = codepoints(text)
        cp = np.where(cp < 1 << 16, _LOWER[np.minimum(cp, 0xFFFF)], cp)
        space = cp == 32
        if len(cp) > 1:
            cp = cp[~(space & np.concatenate([[False], space[:-1]]))]
        cp = np.concatenate([[np.uint32(32)], cp, [np.uint32(32)]]).astype(np.uint32)
        parts, h = [], cp
        for n in range(2, max(ORDERS) + 1):
            if len(cp) < n:
                break
            h = h[:-1] * _BASE + cp[n - 1:]
            if n in ORDERS:
                parts.append(((h ^ (h >> np.uint32(15))) * _MIX + np.uint32(n * 7919)) >> np.uint32(32 - BITS))
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), [len(p) for p in parts]

    def distinct(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(distinct buckets, their features)."""
        idx = self.grams(text)
        at = np.arange(len(idx), dtype=np.int32)
        self.marks[idx] = at
        own = self.marks[idx]
        found = idx[own == at]
        return found, _saturating(np.bincount(own, minlength=len(idx))[self.marks[found]], len(text))

    def features(self, text: str, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slots of the kept buckets that the text holds, their features)."""
        s = slot[self.grams(text)]
        found, n = np.unique(s[s >= 0], return_counts=True)
        return found, _saturating(n, len(text))

    def margin(self, text: str, slot: np.ndarray, weights: np.ndarray) -> float:
        """The highest weighted sum of features of the text and of its windows."""
        idx, sizes = self._grams(text)
        s = slot[idx]
        kept = np.flatnonzero(s >= 0)
        s = s[kept].astype(np.int64)
        found, n = np.unique(s, return_counts=True)
        whole = float((weights[found] * _saturating(n, len(text))).sum())
        if len(text) <= 2 * WINDOW or not len(s):
            return whole
        # A window is two neighbouring halves; an n-gram belongs to the half that it begins in.
        half = (kept - np.repeat(np.cumsum(sizes) - sizes, sizes)[kept]) // (WINDOW // 2)
        many = int(half.max()) + 1
        both = np.concatenate([half, half - 1]) * len(weights) + np.concatenate([s, s])
        pair, n = np.unique(both[both >= 0], return_counts=True)
        sums = np.bincount(pair // len(weights), weights=weights[pair % len(weights)] * _saturating(n, WINDOW), minlength=many)
        return max(whole, float(sums.max()))


@dataclass(frozen=True)
class ToxicityModel:
    """Slot of each bucket (-1: not kept), weights by slot (ratio included), intercept."""

    slot: np.ndarray
    weights: np.ndarray
    bias: float


def constant_model(share: float) -> ToxicityModel:
    bias = 30.0 if share >= 1.0 else -30.0 if share <= 0.0 else 0.0
    return ToxicityModel(np.full(1 << BITS, -1, np.int32), np.zeros(0), bias)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, s1, q1, s0, q0): sums of features and of their squares over this task's toxic and other texts."""
    hasher, sums = Hasher(), np.zeros((2, 2, 1 << BITS), np.int64)
    for batch in batches:
        for part in slices(batch, "_text"):
            for t, y in zip(texts_of(part, "_text"), part.column(0).to_pylist(), strict=True):
                found, value = hasher.distinct(t)
                whole = np.rint(value * UNIT).astype(np.int64)
                sums[y, 0][found] += whole
                sums[y, 1][found] += whole * whole
    b = np.flatnonzero(sums.any(axis=(0, 1)))
    yield pa.RecordBatch.from_arrays([pa.array(b.astype(np.int32)), *(pa.array(sums[y, i][b]) for y in (1, 0) for i in (0, 1))],
                                     names=["bucket", "s1", "q1", "s0", "q0"])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
    """Fit on at most ``sample`` labelled rows of each class (``labels`` holds the rows that may be learnt from)."""
    rows = staged(sample_rows(docs, id_col, text_col, labelled_sample(labels, id_col, label_col, sample))
                  .select("_id", "_y", "_w", "_text"))
    got = {r["_y"]: r for r in rows.groupBy("_y").agg(F.count("*").alias("n"), F.sum("_w").alias("w")).collect()}
    if len(got) < 2:
        return constant_model(float(next(iter(got))) if got else 0.5)
    n1, n0 = got[1]["n"], got[0]["n"]
    seen = staged(rows.select("_y", "_text").mapInArrow(_sums, "bucket int, s1 long, q1 long, s0 long, q0 long")
                  .groupBy("bucket").agg(*[(F.sum(c) / (UNIT if c[0] == "s" else UNIT * UNIT)).alias(c)
                                           for c in ("s1", "q1", "s0", "q0")]))
    total = seen.agg(F.sum(F.col("s1") + SMOOTHING).alias("t"), F.sum(F.col("s0") + SMOOTHING).alias("o")).first()
    rest = SMOOTHING * ((1 << BITS) - seen.count())  # buckets that no sampled text holds
    ratio = (F.log((F.col("s1") + SMOOTHING) / F.lit(float(total["t"] + rest)))
             - F.log((F.col("s0") + SMOOTHING) / F.lit(float(total["o"] + rest))))
    m1, m0 = F.col("s1") / n1, F.col("s0") / n0
    var = (F.col("q1") / n1 - m1 * m1) / n1 + (F.col("q0") / n0 - m0 * m0) / n0 + (0.5 / n1) ** 2
    t = (m1 - m0) / F.sqrt(F.greatest(var, F.lit(1e-12)))
    telling = (seen.select("bucket", ratio.alias("r"), F.round(t, 9).alias("t")).where("t > 0")
               .orderBy(F.desc("t"), "bucket").limit(FEATURES)).toArrow()
    bucket, ratios = telling.column("bucket").to_numpy(), telling.column("r").to_numpy()
    slot = np.full(1 << BITS, -1, np.int32)
    slot[bucket] = np.arange(len(bucket))
    shared = docs.sparkSession.sparkContext.broadcast(slot)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part in slices(batch, "_text"):
                got = [hasher.features(t, shared.value) for t in texts_of(part, "_text")]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(3)), pa.array([g[0].astype("<u2").tobytes() for g in got], pa.binary()),
                     pa.array([g[1].astype("<f4").tobytes() for g in got], pa.binary())], names=["id", "y", "w", "at", "value"])

    found = rows.mapInArrow(features, f"id {rows.schema['_id'].dataType.simpleString()}, y int, w double, at binary, value binary")
    table = found.toArrow().sort_by("id")
    at = [np.frombuffer(x, "<u2") for x in table.column("at").to_pylist()]
    value = [np.frombuffer(x, "<f4") for x in table.column("value").to_pylist()]
    weights, bias = fit_weights(at, value, ratios, table.column("y").to_numpy().astype(np.float64),
                                table.column("w").to_numpy())
    return ToxicityModel(slot, weights, bias)


def fit_weights(at: list[np.ndarray], value: list[np.ndarray], ratios: np.ndarray, y: np.ndarray,
                w: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on the kept features scaled by their ratios: (weights with the ratio in them, intercept)."""
    col = np.concatenate(at).astype(np.int64)
    row = np.repeat(np.arange(len(at)), [len(a) for a in at])
    val = ratios[col] * np.concatenate(value)
    wn, n, k = w / w.sum(), len(at), len(ratios)
    share = float(wn @ y)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(row, weights=val * x[col], minlength=n) + x[k]
        e = wn * (sigmoid(z) - y)
        grad = np.append(np.bincount(col, weights=val * e[row], minlength=k) + PENALTY / n * x[:k], e.sum())
        return log_loss(z, y, wn) + PENALTY / n / 2 * float(x[:k] @ x[:k]), grad

    start = np.zeros(k + 1)
    start[k] = np.log(share / (1 - share))
    x = minimise(loss, start, rounds=200)
    return x[:k] * ratios, float(x[k])


def score_texts(model: ToxicityModel, texts: list[str], hasher: Hasher | None = None) -> np.ndarray:
    hasher = hasher or Hasher()
    z = np.empty(len(texts))
    for i, t in enumerate(texts):
        z[i] = hasher.margin(t, model.slot, model.weights) if len(model.weights) else 0.0
    return sigmoid(z + model.bias)


def score(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text",
          keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: the kept columns and ``score``, the probability of the toxic class."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB, whatever the input's size
    src = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = docs.select(*keep).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part in slices(batch, "_text"):
                s = score_texts(shared.value, texts_of(part, "_text"), hasher)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), pa.array(s)],
                                                 names=[*keep, "score"])

    return src.mapInArrow(run, schema)


def reject(docs: DataFrame, model: ToxicityModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose score is below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(score_texts(shared.value, texts_of(part, text_col), hasher) < threshold))

    return docs.mapInArrow(run, docs.schema)

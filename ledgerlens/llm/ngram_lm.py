"""Language model: interpolated modified Kneser-Ney n-grams, counted in Spark, read through memory maps.

Words are runs of bytes other than white space, A-Z in lower case; every text ends with one end token. The vocabulary is the
sorted array of the words' 64-bit hashes, and a word's id its place there. An n-gram is a tuple of ids; the n - 1
tokens before a text are start tokens. Counting goes down the orders, one Spark job each:

* tasks count the n-grams of their texts (a hot n-gram is one entry of a task's block, whatever its count) and send
  blocks of (ids, counts), dealt by the n-gram's hash, to shards;
* a shard adds up its blocks, writes its n-grams as sorted hash arrays, and sends two things down: how often each context was followed
  and by how many n-grams counted once, twice and more; and each n-gram's last n - 1 ids, whose number of n-grams
  is the lower order's count (how many different words precede it).

Nothing is pruned or capped; the number of shards grows with the text, so that a shard's entries fit a task. Only
counts of counts reach the driver. Scoring tasks memory-map the arrays, look up the sorted distinct n-grams of a slice of
texts, and interpolate: p_k = max(c - D_c, 0) / total + gamma * p_(k-1), with p_0 = 1 / (words + 1), the one more for any unknown word.
D_1, D_2 and D_3 of each order come from its counts of counts; where those give no value between 0 and the count, 0.5, 1 and 1.5 stand in.

The folder must be one that every worker can open by its path (a mounted shared folder); any other raises an error.
Null texts count as empty: the end token alone. Repeated rows count as often as they occur; a null flag in the
training column is no training row. Without training rows every probability is 1. Extra columns may be kept by name.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import slices, staged
from ledgerlens.llm.words import Words, split_words, word_hashes

SLICE_BYTES = 4 << 20  # of text that a task holds as arrays at once
BLOCK_ENTRIES = 2_000_000  # n-grams that a task counts before it sends them
SHARD_BYTES = 16 << 20  # of text for each shard
END = np.uint64(xxhash.xxh3_64_intdigest(b" end"))  # words hold no white space
BLOCKS = "kind string, shard int, n long, width int, data binary"
STATS = "kind string, shard int, n long, total long, n1 long, n2 long, n3 long, n4 long"
FALLBACK = (0.5, 1.0, 1.5)


def mounted(path: str) -> str:
    """The path by which workers open a shared folder."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"{path}: the model's folder must be mounted on every worker, to be memory-mapped")
    return unquote(url.path)


def mix(columns: Sequence[np.ndarray]) -> np.ndarray:
    """64-bit hash of each tuple of ids."""
    h = np.full(len(columns[0]), 0x9E3779B97F4A7C15, np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
    return h


def _summed(keys: np.ndarray, columns: Sequence[np.ndarray], sums: Sequence[np.ndarray]) -> tuple[np.ndarray, list, list]:
    """Sorted distinct keys, their ``columns``, and the totals of ``sums``."""
    if not len(keys):
        return keys, list(columns), list(sums)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], [c[order[first]] for c in columns], [np.add.reduceat(s[order], first) for s in sums]


def _shards(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of sorted keys by their leading bits."""
    which = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    at = np.flatnonzero(np.append(True, which[1:] != which[:-1])) if len(keys) else np.empty(0, np.int64)
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(keys)], strict=True):
        yield int(which[a]), a, b


def _planes(a: np.ndarray) -> bytes:
    """An array's bytes, lowest ones first: leading zeros then compress away."""
    return np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _blocks(kind: str, keys: np.ndarray, columns: Sequence[np.ndarray], bits: int) -> Iterator[tuple]:
    """Rows of BLOCKS for sorted keys: their columns, compressed, for each shard."""
    for shard, a, b in _shards(keys, bits):
        raw = b"".join(_planes(c[a:b]) for c in columns)
        yield kind, shard, b - a, len(columns), pa.compress(raw, codec="zstd", asbytes=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_BLOCK_ARROW = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("n", pa.int64()), ("width", pa.int32()), ("data", pa.binary())])


def _columns(table: pa.Table) -> list[np.ndarray]:
    """The joined columns of a shard's blocks."""
    parts = []
    for n, width, data in zip(*(table.column(c).to_pylist() for c in ("n", "width", "data")), strict=True):
        raw = np.frombuffer(pa.decompress(data, decompressed_size=8 * n * width, codec="zstd"), np.uint8)
        parts.append([np.ascontiguousarray(p.reshape(8, n).T).view("<u8").reshape(n) for p in raw.reshape(width, -1)])
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def _save(folder: str, shard: int, **arrays: np.ndarray) -> None:
    """One file for each array; a repeated task writes the same again."""
    os.makedirs(folder, exist_ok=True)
    for name, a in arrays.items():
        if a.dtype.kind == "u" and name != "keys":
            a = a.astype(np.min_scalar_type(int(a.max(initial=0))))
        at = os.path.join(folder, f"{shard:06d}.{name}.npy")
        with open(f"{at}.{uuid.uuid4().hex}", "wb") as f:
            np.save(f, a)
        os.replace(f.name, at)


@lru_cache(maxsize=4096)
def _mapped(at: str) -> np.ndarray | None:
    try:
        return np.load(at, mmap_mode="r")
    except FileNotFoundError:  # a shard without entries
        return None
    except ValueError:  # an empty array can't be mapped
        return np.load(at)


def look_up(folder: str, bits: int, keys: np.ndarray, names: Sequence[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which of the sorted keys the arrays hold, and the named values of each (0 where not). ``place`` is the place in its shard."""
    found = np.zeros(len(keys), bool)
    values = [np.zeros(len(keys), np.float64 if n in ("gamma", "total") else np.uint64) for n in names]
    for shard, a, b in _shards(keys, bits):
        at = os.path.join(folder, f"{shard:06d}")
        held = _mapped(f"{at}.keys.npy")
        if held is None or not len(held):
            continue
        place = np.searchsorted(held, keys[a:b])
        hit = held[np.minimum(place, len(held) - 1)] == keys[a:b]
        found[a:b] = hit
        for name, v in zip(names, values, strict=True):
            v[a:b][hit] = place[hit] if name == "place" else _mapped(f"{at}.{name}.npy")[place[hit]]
    return found, values


@dataclass
class Model:
    """Where the arrays lie and the numbers that all of them share."""

    path: str
    order: int
    bits: int
    words: int = 0  # distinct tokens in training
    tokens: int = 0
    first_id: list[int] = field(default_factory=list)  # of each vocabulary shard
    discounts: dict[int, tuple[float, float, float]] = field(default_factory=dict)
    bottom: tuple[float, float] = (0.0, 0.0)  # total of the lowest order's counts; gamma

    def folder(self, name: str) -> str:
        return os.path.join(self.path, name)


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes with an end token after each text, starts of the texts, place of each token in its text)."""
    n = len(words.starts) - 1
    ends = words.starts[1:] + np.arange(n)
    codes = np.empty(len(words.codes) + n, np.int64)
    is_end = np.zeros(len(codes), bool)
    is_end[ends] = True
    codes[is_end] = len(words.entries)
    codes[~is_end] = words.codes
    starts = np.append(0, ends + 1)
    return codes, starts, np.arange(len(codes)) - np.repeat(starts[:-1], np.diff(starts))


def _hashes(words: Words) -> np.ndarray:
    return np.append(word_hashes(words.entries), END)


def _ids(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, training count) of each hash; unknown words share the id ``words``."""
    order = np.argsort(hashes)
    keys = hashes[order]
    found, (place, count) = look_up(model.folder("vocabulary"), model.bits, keys, ("place", "counts"))
    first = np.array(model.first_id, np.uint64)[(keys >> np.uint64(64 - model.bits)).astype(np.int64) if model.bits else 0]
    ids, counts = np.empty(len(keys), np.uint64), np.empty(len(keys), np.uint64)
    ids[order] = np.where(found, place + first, np.uint64(model.words))
    counts[order] = count
    return ids, counts


def _grams(ids: np.ndarray, place: np.ndarray, order: int, start: int) -> list[np.ndarray]:
    """The columns of every token's n-gram, the token last; ``start`` stands for places before the text."""
    out = []
    for back in range(order - 1, 0, -1):
        c = np.roll(ids, back)
        c[place < back] = start
        out.append(c)
    return [*out, ids]


def _mapped_blocks(docs: DataFrame, kind: str, bits: int, entries: Callable[[pa.Array], tuple]) -> DataFrame:
    """Blocks of the training texts: ``entries`` gives (keys, columns, counts) of a slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, columns, (counts,) = _summed(np.concatenate([h[0] for h in held]),
                                               [np.concatenate(c) for c in zip(*(h[1] for h in held), strict=True)],
                                               [np.concatenate([h[2] for h in held])])
            for row in _blocks(kind, keys, [*columns, counts], bits):
                yield _batch([row], _BLOCK_ARROW)

        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                held.append(entries(part.column(0)))
                size += len(held[-1][0])
                if size >= BLOCK_ENTRIES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return docs.mapInArrow(run, BLOCKS)


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == i).sum()) for i in (1, 2, 3, 4)]


_STAT_ARROW = pa.schema([("kind", pa.string()), ("shard", pa.int32()), *[(c, pa.int64()) for c in ("n", "total", "n1", "n2", "n3", "n4")]])


def _vocabulary(docs: DataFrame, model: Model) -> None:
    """Write the sorted hashes and counts of all training tokens; set ids and totals."""
    def entries(texts: pa.Array) -> tuple:
        words = split_words(texts, lower=True)
        hashes = _hashes(words)
        counts = np.append(np.bincount(words.codes, minlength=len(words.entries)), len(texts))
        return hashes, [hashes], counts.astype(np.uint64)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        hashes, counts = _columns(table)
        keys, _, (counts,) = _summed(hashes, [], [counts])
        _save(model.folder("vocabulary"), key[0].as_py(), keys=keys, counts=counts)
        row = ("vocabulary", key[0].as_py(), len(keys), int(counts.sum()), 0, 0, 0, 0)
        return pa.Table.from_batches([_batch([row], _STAT_ARROW)])

    stats = _mapped_blocks(docs, "vocabulary", model.bits, entries).groupBy("shard").applyInArrow(merge, STATS).collect()
    sizes = np.zeros(1 << model.bits, np.int64)
    for r in stats:  # one row for each shard
        sizes[r["shard"]] = r["n"]
    model.words, model.tokens = int(sizes.sum()), sum(r["total"] for r in stats)
    model.first_id = (np.cumsum(sizes) - sizes).tolist()


def _discounts(n: Sequence[int]) -> tuple[float, float, float]:
    """D_1, D_2, D_3 from the counts of counts n1 to n4."""
    out = []
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    for i in (1, 2, 3):
        d = i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else 0.0
        out.append(d if 0 < d < i else FALLBACK[i - 1])
    return tuple(out)


def _level(blocks: DataFrame, model: Model, order: int, above: tuple[float, float, float]) -> DataFrame:
    """Add up one order's n-grams and the contexts of the order above; returns the next blocks and the order's counts of counts."""
    bits = model.bits

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        kind, shard = key[0].as_py(), key[1].as_py()
        columns = _columns(table)
        if kind == "context":  # key, total, followers counted once, twice, more often
            keys, _, (total, *n) = _summed(columns[0], [], columns[1:])
            gamma = sum(d * c for d, c in zip(above, n, strict=True)) / total
            _save(model.folder(f"context{order}"), shard, keys=keys, total=total.astype(np.float64), gamma=gamma.astype(np.float32))
            return _batch_table([])
        ids = columns[:-1]
        keys, ids, (counts,) = _summed(mix(ids), ids, [columns[-1]])
        _save(model.folder(f"grams{order}"), shard, keys=keys, counts=counts)
        rows = [("stat", shard, len(keys), 0, np.array([int(counts.sum()), *_counts_of_counts(counts)], "<i8").tobytes())]
        if order > 1:
            few = [(counts == 1), (counts == 2), (counts > 2)]
            found = _summed(mix(ids[:-1]), [], [counts, *(f.astype(np.uint64) for f in few)])
            rows += _blocks("context", found[0], [found[0], *found[2]], bits)
            down, ids, (lefts,) = _summed(mix(ids[1:]), ids[1:], [np.ones(len(keys), np.uint64)])
            rows += _blocks("gram", down, [*ids, lefts], bits)
        return _batch_table(rows)

    return staged(blocks.groupBy("kind", "shard").applyInArrow(merge, BLOCKS))


def _batch_table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, _BLOCK_ARROW)])


def fit(docs: DataFrame, folder: str, *, text_col: str, order: int) -> Model:
    """Count the model of every text of ``docs`` into arrays below ``folder``."""
    docs = docs.select(F.col(text_col).cast("string").alias("_text"))
    size = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    model = Model(mounted(folder), order, max(0, int(np.ceil(np.log2(max(1, size / SHARD_BYTES))))))
    _vocabulary(docs, model)

    def entries(texts: pa.Array) -> tuple:
        words = split_words(texts, lower=True)
        codes, _, place = _tokens(words)
        ids, _ = _ids(model, _hashes(words))
        grams = _grams(ids[codes], place, order, model.words + 1)
        keys, columns, (counts,) = _summed(mix(grams), grams, [np.ones(len(codes), np.uint64)])
        return keys, columns, counts

    blocks = _mapped_blocks(docs, "gram", model.bits, entries)
    above = FALLBACK
    for k in range(order, 0, -1):
        out = _level(blocks, model, k, above)
        stats = [np.frombuffer(r["data"], "<i8") for r in out.where("kind = 'stat'").select("data").collect()]
        total, *n = np.sum(stats, axis=0).tolist() if stats else [0] * 5
        above = model.discounts[k] = _discounts(n)
        types = out.where("kind = 'stat'").agg(F.sum("n")).first()[0] or 0
        if k == 1:
            more = types - n[0] - n[1]
            gamma = (above[0] * n[0] + above[1] * n[1] + above[2] * more) / total if total else 1.0
            model.bottom = (float(total), gamma)
        blocks = out.where("kind <> 'stat'")
    return model


def probabilities(model: Model, grams: list[np.ndarray]) -> np.ndarray:
    """p of the last id of every n-gram, given the ids before it."""
    order = len(grams)
    p = np.full(len(grams[0]), 1.0 / (model.words + 1))
    for k in range(1, order + 1):
        keys, inverse = np.unique(mix(grams[order - k:]), return_inverse=True)
        _, (counts,) = look_up(model.folder(f"grams{k}"), model.bits, keys, ("counts",))
        d = np.array([0.0, *model.discounts[k]])[np.minimum(counts, np.uint64(3)).astype(np.int64)]
        left = np.maximum(counts.astype(np.float64) - d, 0.0)[inverse]
        if k == 1:
            total, gamma = model.bottom
            p = left / total + gamma * p if total else p
            continue
        keys, inverse = np.unique(mix(grams[order - k:-1]), return_inverse=True)
        seen, (total, gamma) = look_up(model.folder(f"context{k - 1}"), model.bits, keys, ("total", "gamma"))
        seen, total, gamma = seen[inverse], total[inverse], gamma[inverse]
        p = np.where(seen, left / np.where(seen, total, 1.0) + gamma * p, p)
    return p


def score(docs: DataFrame, model: Model, *, text_col: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns, n_tokens, n_known, base_score and score (log10 probabilities of the whole text) of every row."""
    fields = [f for f in docs.schema.fields if f.name in keep]
    rows = docs.select(F.col(text_col).cast("string").alias("_text"), *[F.col(f"`{f.name}`") for f in fields])
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                words = split_words(part.column(0), lower=True)
                codes, starts, place = _tokens(words)
                ids, counts = _ids(model, _hashes(words))
                base = np.log10((counts + 0.1) / (model.tokens + 0.1 * (model.words + 1)))
                p = probabilities(model, _grams(ids[codes], place, model.order, model.words + 1))
                sums = [np.add.reduceat(x, starts[:-1]) for x in ((counts[codes] > 0).astype(np.int64), base[codes], np.log10(p))]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(np.diff(starts)), *map(pa.array, sums)],
                                                 names=[*[f.name for f in fields], "n_tokens", "n_known", "base_score", "score"])

    return rows.mapInArrow(run, f"{kept}, n_tokens long, n_known long, base_score double, score double")


def perplexity(scored: DataFrame) -> DataFrame:
    """(n_tokens, perplexity, base_perplexity) of all rows of ``score``."""
    n = F.sum("n_tokens")
    return scored.agg(n.alias("n_tokens"), F.pow(F.lit(10.0), -F.sum("score") / n).alias("perplexity"),
                      F.pow(F.lit(10.0), -F.sum("base_score") / n).alias("base_perplexity"))

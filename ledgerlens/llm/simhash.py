"""SimHash near-dedup over a vantage-point tree that also deals the fingerprints out.

Fingerprints: lower-case A-Z, split at ASCII white space, word shingles with
repeats, XXH64 (seed 42) of each; a bit is set if it is set in more than half of
the hashes. Different fingerprints (class representatives) go down a tree of
vantage points: below a point, those within the radius go left, the others
right. By the triangle inequality two fingerprints at most d bits apart can fall
on different sides only within d of the radius, so those, and only those, also
visit the other side as queries. Each leaf is one shard; a shard goes on with a
tree of its own and compares the members of its leaves exactly. Only a spanning
forest of a shard's links leaves it, as many rows as it read at most.

Null text counts as empty: fingerprint zero, linked like any other. One row per
input row; repeated ids keep their rows and share the smallest id reachable by
any of them. Rows with a null id are kept with a fingerprint; they take part
through it and get the component of it, null if no row of it has an id.
Extra columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import slices, staged
from ledgerlens.llm.graph import Forest, components

SHARD = 40_000  # fingerprints that a shard of the tree aims at
TREE_SAMPLE = 65_536  # fingerprints from which the dealing tree is made, at most
LEAF = 96  # members compared directly within a shard
PAIR_BLOCK = 1 << 20  # comparisons held as one array
_SEED = 42


def fingerprint_text(text: bytes, words_in: int) -> int:
    """The 64-bit fingerprint of one text given as UTF-8."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    stops = np.cumsum(np.array([len(w) + 1 for w in words], np.int64)) - 1
    begins = np.append(0, stops[:-1] + 1)
    k = min(words_in, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], _SEED) for a, b in
                       zip(begins[:len(words) - k + 1].tolist(), stops[k - 1:].tolist(), strict=True)], np.uint64)
    set_in = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bits of one stretch at a time: memory stays bounded
        part = hashes[i:i + (1 << 16)]
        set_in += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(hashes)).view(">u8")[0])


def fingerprints(rows: DataFrame, text_col: str, words: int, keep: list[str]) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint of every row as a signed long."""
    schema = rows.select(*keep).schema.add("fp", "long")
    if text_col not in keep:
        rows = rows.select(*keep, text_col)
    at = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                col = part.column(at).cast(pa.binary()).to_pylist()
                fps = np.array([fingerprint_text(t or b"", words) for t in col], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), pa.array(fps)],
                                                 names=[*keep, "fp"])

    return rows.mapInArrow(run, schema)


def _distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _split(fps: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point among ``fps`` and the radius that halves them best; None if none splits them."""
    best = None
    tries = fps[np.linspace(0, len(fps) - 1, min(8, len(fps))).astype(int)]
    for vp in tries:
        d = _distance(fps, vp)
        hist = np.bincount(d, minlength=65)
        below = np.cumsum(hist)
        r = int(np.argmin(np.abs(below - len(fps) / 2)))
        if 0 < below[r] < len(fps):
            # Uneven halves and many fingerprints near the radius both cost.
            near = hist[max(0, r - 1):r + 3].sum()
            cost = abs(int(below[r]) - len(fps) / 2) + 0.5 * near
            if best is None or cost < best[0]:
                best = (cost, vp, r)
    return None if best is None else (best[1], best[2])


def dealing_tree(sample: np.ndarray, leaf: int) -> list:
    """Nested [vantage point, radius, left, right] with shard numbers as leaves, from a bounded sample."""
    count = iter(range(1 << 30))

    def grow(fps: np.ndarray) -> list | int:
        cut = _split(fps) if len(fps) > leaf else None
        if cut is None:
            return next(count)
        near = _distance(fps, cut[0]) <= cut[1]
        return [cut[0], cut[1], grow(fps[near]), grow(fps[~near])]

    return grow(sample)


def route(tree: list | int, fps: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, member positions, query positions) for the fingerprints that reach each shard.

    A member visits the near side of a foreign boundary only as a query from the
    far side; every close pair meets in the shard of one of its two ends.
    """
    work = [(tree, np.arange(len(fps)), np.zeros(0, np.int64))]
    while work:
        node, mine, other = work.pop()
        if not len(mine) and not len(other):
            continue
        if not isinstance(node, list):
            yield node, mine, other
            continue
        vp, r, left, right = node
        dm, do = _distance(fps[mine], vp), _distance(fps[other], vp)
        crossing = mine[(dm > r) & (dm <= r + bits)]
        work.append((left, mine[dm <= r], np.concatenate([other[do <= r + bits], crossing])))
        work.append((right, mine[dm > r], other[do > r - bits]))


def shard_links(fps: np.ndarray, members: int, bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among the first ``members`` and between them and the other queries."""
    forest = Forest(len(fps))

    def grow(mine: np.ndarray, other: np.ndarray) -> None:
        cut = _split(fps[mine]) if len(mine) > LEAF else None
        if cut is None:
            both = np.concatenate([mine, other])
            rows = max(1, PAIR_BLOCK // max(1, len(both)))
            for i in range(0, len(mine), rows):
                part = mine[i:i + rows]
                a, b = np.nonzero(_distance(fps[part][:, None], fps[both][None, :]) <= bits)
                later = b > a + i  # members after it, and all queries
                forest.link(part[a[later]], both[b[later]])
            return
        vp, r = cut
        dm, do = _distance(fps[mine], vp), _distance(fps[other], vp)
        near = dm <= r
        grow(mine[near], np.concatenate([other[do <= r + bits], mine[~near & (dm <= r + bits)]]))
        grow(mine[~near], other[do > r - bits])

    if members and len(fps) > 1:
        grow(np.arange(members), np.arange(members, len(fps)))
    return forest.links


def links(classes: DataFrame, *, bits: int = 2, shard: int = SHARD) -> DataFrame:
    """(u, v): links that connect the different fingerprints ``fp`` of ``classes`` as all links would."""
    spark = classes.sparkSession
    n = classes.count()
    share = max(1, math.ceil(n / TREE_SAMPLE))
    sample = (classes.where(F.pmod(F.xxhash64("fp"), F.lit(share)) == 0)
              .orderBy(F.xxhash64("fp"), "fp").limit(TREE_SAMPLE).toArrow())
    fps = sample.column("fp").to_numpy().view(np.uint64)
    tree = spark.sparkContext.broadcast(dealing_tree(fps, max(2, int(shard * len(fps) / max(1, n)))))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = batch.column(0).to_numpy().view(np.uint64)
            for s, mine, other in route(tree.value, f, bits):
                at = np.concatenate([mine, other])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), s, np.int32)), pa.array(f[at].view(np.int64)),
                     pa.array(np.arange(len(at)) < len(mine))], names=["shard", "fp", "member"])

    def compare(group: pa.Table) -> pa.Table:
        f = group.column("fp").to_numpy().view(np.uint64)
        member = group.column("member").to_numpy()
        f = np.concatenate([np.sort(f[member]), f[~member]])
        found = np.array(shard_links(f, int(member.sum()), bits), np.int64).reshape(-1, 2)
        return pa.table({"u": f[found[:, 0]].view(np.int64), "v": f[found[:, 1]].view(np.int64)})

    dealt = classes.select("fp").mapInArrow(deal, "shard int, fp long, member boolean")
    return dealt.groupBy("shard").applyInArrow(compare, "u long, v long")


def groups(prints: DataFrame, bits: int) -> DataFrame:
    """(fp, root): every different ``fp`` with one fingerprint that stands for all reachable from it."""
    classes = staged(prints.select("fp").distinct())
    linked = components(links(classes, bits=bits))
    return classes.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "fp").alias("root"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    bits: int = 2) -> DataFrame:
    """(id, fp, component_id): one row per input row.

    ``component_id`` is the smallest id reachable over links of at most ``bits`` differing bits.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    prints = staged(fingerprints(src, "t", words, ["id"]))
    of = staged(groups(prints, bits))
    low = prints.groupBy("fp").agg(F.min("id").alias("low")).join(of, "fp")
    least = low.groupBy("root").agg(F.min("low").alias("component_id"))
    named = low.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("id", "fp", "component_id")


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
               bits: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, one of each group: the smallest id's (ids before nulls).

    Of repeated rows with that id one stays.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]  # own names: the table's can't clash with ours
    id_at, text_at = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    rows = docs.toDF(*names).withColumn("row", F.monotonically_increasing_id())
    rows = staged(fingerprints(rows, text_at, words, [*names, "row"]))
    prints = rows.select("fp", "row", F.col(id_at).alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("n"), "id", "row"))
    of = staged(groups(prints, bits))
    least = prints.groupBy("fp").agg(first.alias("f")).join(of, "fp").groupBy("root").agg(F.min("f").alias("f"))
    stay = least.select(F.col("f.row").alias("row"))
    gone = prints.select("row").join(stay, "row", "left_anti")
    return rows.join(gone, "row", "left_anti").select(*names).toDF(*docs.columns)

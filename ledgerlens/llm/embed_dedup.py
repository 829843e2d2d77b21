"""Embedding near-dedup by tiled comparison in PCA order.

A rotation onto the principal axes (fitted on a bounded sample; it changes how
early a comparison stops, never its result) puts the telling dimensions first.
The sample also gives planes along the leading axes that cut space into boxes;
a box's vectors, split further by a hash where there are many, are a tile. A pair
of tiles meets in one task, which gets only those vectors that lie near enough to
the other tile's box. There, blocks of both tiles accumulate products of leading
dimensions; what the rest can add is at most the product of the suffix norms, and
a pair stops once that can't reach the threshold. What is left is decided by the
cosine of the original vectors in double precision.

Equal vectors are one vector with a number of copies, so a common vector is compared once; its copies count in the numbers
of links and share its component.

Vectors that are null, zero, hold null or non-finite components, or have another
length than most, link with nothing. Of rows with one id but different vectors
the smallest valid vector stands for the id. One row per input row; rows without
an id link with nothing, have a null component and are kept. Other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import staged
from ledgerlens.llm.graph import Forest, components

SAMPLE = 20_000  # vectors that the axes and the boxes are fitted on, at most
SAMPLE_BYTES = 48 << 20
TILE = 4096
TILE_BYTES = 16 << 20
BLOCK = 1024
STEPS = (8, 16, 32, 64, 128, 256, 512)  # leading dimensions after which bounds are tested
SLACK = 1e-7  # for rounding in bounds


def valid_vector(vec: Column) -> Column:
    """No null or non-finite component, and one that is not zero."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def matrix(col: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a float64 matrix."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first: squares of very large or small components would overflow or vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Tiles:
    """Boxes made by planes across the leading axes, cut into tiles of about ``tile`` vectors."""

    def __init__(self, sample: np.ndarray, total: int, tile: int, reach: float):
        _, vecs = np.linalg.eigh(sample.T @ sample) if len(sample) else (None, np.eye(sample.shape[1]))
        self.axes = np.ascontiguousarray(vecs[:, ::-1])
        self.reach = reach
        turned = sample @ self.axes
        scale = total / max(1, len(sample))
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.first: list[int] = []  # first tile of each box
        self.parts: list[int] = []
        self.planes: list = []
        lead = min(8, sample.shape[1])

        def grow(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> list | int:
            if len(rows) * scale > tile and len(rows) > 1:
                spread = np.var(turned[rows][:, :lead], axis=0)
                axis = int(spread.argmax())
                at = float(np.median(turned[rows, axis]))
                left = turned[rows, axis] < at
                if 0 < left.sum() < len(rows):
                    h, lo = high.copy(), low.copy()
                    h[axis], lo[axis] = at, at
                    return [axis, at, grow(rows[left], low, h), grow(rows[~left], lo, high)]
            self.low.append(low)
            self.high.append(high)
            self.first.append(sum(self.parts))
            self.parts.append(max(1, math.ceil(len(rows) * scale / tile)))
            return len(self.low) - 1

        inf = np.full(sample.shape[1], np.inf)
        self.tree = grow(np.arange(len(sample)), -inf, inf)

    def box_of(self, turned: np.ndarray) -> np.ndarray:
        out = np.empty(len(turned), np.int64)
        work = [(self.tree, np.arange(len(turned)))]
        while work:
            node, rows = work.pop()
            if isinstance(node, list):
                left = turned[rows, node[0]] < node[1]
                work += [(node[2], rows[left]), (node[3], rows[~left])]
            else:
                out[rows] = node
        return out

    def meetings(self, unit: np.ndarray, salt: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(lower tile, higher tile, own tile, rows): the pairs of tiles that each vector takes part in."""
        turned = unit @ self.axes
        box = self.box_of(turned)
        own = np.array(self.first)[box] + salt % np.array(self.parts)[box]
        for b, (low, high) in enumerate(zip(self.low, self.high, strict=True)):
            cut = np.flatnonzero(np.isfinite(low) | np.isfinite(high))
            t = turned[:, cut]
            gap = np.maximum(np.maximum(low[cut] - t, t - high[cut]), 0.0)
            near = (gap * gap).sum(axis=1) <= (self.reach + SLACK) ** 2
            for tile in range(self.first[b], self.first[b] + self.parts[b]):
                for mine in np.unique(own[near]).tolist():
                    yield min(mine, tile), max(mine, tile), mine, np.flatnonzero(near & (own == mine))


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float, axes: np.ndarray,
                same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i in a, j in b) with cosine >= threshold, block by block; j > i where ``same``."""
    def ready(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        unit = _unit(x)
        t = unit @ axes
        back = np.cumsum((t * t)[:, ::-1], axis=1)[:, ::-1]
        return unit, t, [np.sqrt(back[:, s]) if s < t.shape[1] else np.zeros(len(t)) for s in stops]

    stops = [s for s in STEPS if s < a.shape[1]] + [a.shape[1]]
    ua, ta, sa = ready(a)
    ub, tb, sb = (ua, ta, sa) if same else ready(b)
    for i in range(0, len(a), BLOCK):
        for j in range(i if same else 0, len(b), BLOCK):
            ii, jj = slice(i, i + BLOCK), slice(j, j + BLOCK)
            dots, done = 0.0, 0
            p = q = None
            for k, s in enumerate(stops):
                if p is None:
                    dots = dots + ta[ii, done:s] @ tb[jj, done:s].T
                    alive = dots + sa[k][ii, None] * sb[k][None, jj] >= threshold - SLACK
                    count = int(alive.sum())
                    if not count:
                        break
                    if count <= alive.size // 16 or s == stops[-1]:
                        p, q = np.nonzero(alive)
                        dots, p, q = dots[p, q], p + i, q + j
                else:
                    dots = dots + np.einsum("ij,ij->i", ta[p, done:s], tb[q, done:s])
                    keep = dots + sa[k][p] * sb[k][q] >= threshold - SLACK
                    p, q, dots = p[keep], q[keep], dots[keep]
                    if not len(p):
                        break
                done = s
            if p is None or not len(p):
                continue
            if same:
                p, q = p[q > p], q[q > p]
            for c in range(0, len(p), 1 << 16):
                x, y = a[p[c:c + (1 << 16)]], b[q[c:c + (1 << 16)]]
                cos = np.einsum("ij,ij->i", x, y) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))
                odd = ~np.isfinite(cos)
                if odd.any():
                    cos[odd] = np.einsum("ij,ij->i", _unit(x[odd]), _unit(y[odd]))
                hit = cos >= threshold
                if hit.any():
                    yield p[c:c + (1 << 16)][hit], q[c:c + (1 << 16)][hit]


def links(vectors: DataFrame, *, threshold: float = 0.9, tile: int = TILE) -> DataFrame:
    """(kind, a, b) for valid vectors (id long, vec array): kind 0, id and direct links; kind 1, a link.

    Links of kind 1 connect what all links connect: a spanning forest for each pair of tiles. With a column ``copies``
    a link to a vector counts as many times as that has copies.
    """
    spark = vectors.sparkSession
    if "copies" not in vectors.columns:
        vectors = vectors.withColumn("copies", F.lit(1).cast("long"))
    head = vectors.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    n, d = head["n"], head["d"] or 1
    most = max(64, min(SAMPLE, SAMPLE_BYTES // (8 * d)))
    share = max(1, n // most)
    sample = (vectors.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).orderBy(F.xxhash64("id"), "id")
              .limit(most).select("vec").toArrow().column("vec").combine_chunks())
    unit = _unit(matrix(sample)) if len(sample) else np.zeros((0, d))
    size = max(256, min(tile, TILE_BYTES // (8 * d)))
    tiles = spark.sparkContext.broadcast(Tiles(unit, n, size, math.sqrt(max(0.0, 2 - 2 * threshold))))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = matrix(batch.column(1))
            salt = batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
            for lo, hi, mine, rows in tiles.value.meetings(_unit(x), salt.astype(np.int64)):
                if len(rows):
                    part = batch.take(pa.array(rows))
                    fill = [pa.array(np.full(len(rows), v, np.int32)) for v in (lo, hi, mine)]
                    yield pa.RecordBatch.from_arrays([*fill, *part.columns], names=["lo", "hi", "mine", "id", "vec", "copies"])

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        mine = group.column("mine").to_numpy()
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        ids = group.column("id").to_numpy()
        x = matrix(group.column("vec").combine_chunks())
        at = np.flatnonzero(mine == lo)
        to = at if lo == hi else np.flatnonzero(mine == hi)
        copies = group.column("copies").to_numpy()
        degree, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
        for p, q in close_pairs(x[at], x[to], threshold, tiles.value.axes, lo == hi):
            p, q = at[p], to[q]
            np.add.at(degree, p, copies[q])
            np.add.at(degree, q, copies[p])
            forest.link(p, q)
        has = np.flatnonzero(degree)
        pairs = np.array(forest.links, np.int64).reshape(-1, 2)
        return pa.table({"kind": pa.array(np.repeat(np.array([0, 1], np.int32), [len(has), len(pairs)])),
                         "a": np.concatenate([ids[has], ids[pairs[:, 0]]]),
                         "b": np.concatenate([degree[has], ids[pairs[:, 1]]])})

    vec_type = vectors.schema["vec"].dataType.simpleString()
    dealt = vectors.select("id", "vec", "copies").mapInArrow(deal, f"lo int, hi int, mine int, id long, vec {vec_type}, copies long")
    return dealt.groupBy("lo", "hi").applyInArrow(compare, "kind int, a long, b long")


def usable(vectors: DataFrame, *, id_col: str, vec_col: str) -> DataFrame:
    """(id long, vec): one row for each id with a valid vector of the table's most frequent length."""
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    fine = src.where(F.col("id").isNotNull() & valid_vector(F.col("vec")))
    size = fine.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if size is None:
        return fine
    fine = fine.where(F.size("vec") == size["d"])
    if fine.groupBy("id").count().where("count > 1").isEmpty():
        return fine
    return fine.groupBy("id").agg(F.min("vec").alias("vec"))


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = 0.9) -> DataFrame:
    """(id, n_links, component_id, kept): one row per input row."""
    use = staged(usable(vectors, id_col=id_col, vec_col=vec_col))
    classes = staged(use.groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("copies")).select("id", "vec", "copies"))
    found = staged(links(classes, threshold=threshold))
    degree = found.where("kind = 0").groupBy("a").agg(F.sum("b").alias("n"))
    parts = components(found.where("kind = 1").select(F.col("a").alias("u"), F.col("b").alias("v")))
    # A class by its smallest id; only members of classes with copies need to look theirs up.
    more = classes.where("copies > 1").select("vec", F.col("id").alias("_first"), "copies")
    members = use.join(more, "vec").select(F.col("id").alias("_member"), "_first", "copies")
    ids = vectors.select(F.col(id_col).alias("id")).join(members, F.col("id") == F.col("_member"), "left")
    ids = ids.select("id", F.coalesce("_first", "id").alias("_first"), (F.coalesce("copies", F.lit(1)) - 1).alias("_twins"))
    out = ids.join(degree, F.col("_first") == F.col("a"), "left").join(parts, F.col("_first") == F.col("node"), "left")
    comp = F.coalesce("component", "_first")
    return out.select("id", (F.coalesce("n", F.lit(0)) + F.col("_twins")).cast("long").alias("n_links"), comp.alias("component_id"),
                      F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"))

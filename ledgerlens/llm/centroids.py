"""Exact k-means over integer vectors whose dimension blocks are dictionary-encoded without loss.

Vectors are dealt into segments. In a segment every block of dimensions becomes a dictionary of
its distinct subvectors and one code a vector. A block whose dictionary would hold more than half as many
entries as the segment has vectors is halved, down to single dimensions, so copies share wide blocks
and other data share single values. Segments are written once; each round computes the squared distance of
every dictionary entry to every centroid once, adds up a vector's partial distances by its codes, and sums the
vectors of a cluster by counting codes. All arithmetic is on integers, so results do not depend on the dealing.

Only sums for each (cluster, dimension) leave the tasks; their number is that of the centroids' components.
A vector that is null, has another number of components, or holds null or non-finite components takes no part.
Repeated rows are vectors of their own; a null id counts as the empty text in the order that picks the first
centroids, and of equal hashes the smaller vector comes first. With fewer vectors than centroids each vector starts
one; an empty table gives an empty result. Components beyond 2**27 after scaling raise an error: their distances
would not fit a long. Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import staged

SEGMENT = 16_384  # vectors of a segment; codes fit 16 bits
WIDEST = 8  # dimensions of the widest block
LARGEST = 1 << 27  # of a component, so that a distance fits 63 bits
SCHEMA = "ids array<long>, layout array<int>, entries binary, codes binary"


@dataclass
class Clustering:
    """``assigned``: (id, cluster, distance) for every vector, written; ``centroids``: the final ones."""

    assigned: DataFrame
    centroids: list[list[int]]


def integer_vectors(df: DataFrame, *, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of every usable vector's components, x as double."""
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.where((F.size("v") == dims) & usable).select(
        "id", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x).cast("long")).alias("v"))


def distinct_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of an integer matrix and each row's position among them."""
    if x.shape[1] == 1:
        values, codes = np.unique(x[:, 0], return_inverse=True)
        return values[:, None], codes
    odd = (np.arange(x.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    hashes = (x.astype(np.uint64) * odd).sum(axis=1, dtype=np.uint64)
    hashes ^= hashes >> np.uint64(31)
    _, first, codes = np.unique(hashes, return_index=True, return_inverse=True)
    values = x[first]
    if not np.array_equal(values[codes], x):  # two rows with one hash
        values, codes = np.unique(x, axis=0, return_inverse=True)
    return values, codes.reshape(-1)


def encode_blocks(x: np.ndarray, widest: int = WIDEST) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(first dimension, distinct subvectors, codes) of every block of a segment."""
    todo = [(lo, min(lo + widest, x.shape[1])) for lo in range(0, x.shape[1], widest)][::-1]
    blocks = []
    while todo:
        lo, hi = todo.pop()
        values, codes = distinct_rows(x[:, lo:hi])
        if 2 * len(values) > len(x) and hi - lo > 1:
            mid = (lo + hi) // 2
            todo += [(mid, hi), (lo, mid)]
        else:
            blocks.append((lo, values, codes))
    return blocks


def segments(vectors: DataFrame, dims: int) -> DataFrame:
    """Segments of dictionary-encoded vectors, from (id, v)."""
    def segment(ids: list[pa.Array], parts: list[np.ndarray]) -> pa.RecordBatch:
        x = np.concatenate(parts)
        if len(x) and int(np.abs(x).max()) > LARGEST:
            raise ValueError(f"a component is beyond {LARGEST} after scaling; its distances do not fit a long")
        blocks = encode_blocks(x)
        layout = [n for lo, values, _ in blocks for n in (lo, values.shape[1], len(values))]
        entries = b"".join(v.astype("<i4").tobytes() for _, v, _ in blocks)
        codes = b"".join(c.astype("<u2").tobytes() for _, _, c in blocks)
        ids_col = pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.concat_arrays(ids))
        return pa.RecordBatch.from_arrays([ids_col, pa.array([layout], pa.list_(pa.int32())), pa.array([entries], pa.binary()),
                                           pa.array([codes], pa.binary())], names=["ids", "layout", "entries", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        parts: list[np.ndarray] = []
        held = 0
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            at = 0
            while at < len(x):
                n = min(len(x) - at, SEGMENT - held)
                ids.append(batch.column(0).slice(at, n))
                parts.append(x[at:at + n])
                at, held = at + n, held + n
                if held == SEGMENT:
                    yield segment(ids, parts)
                    ids, parts, held = [], [], 0
        if held:
            yield segment(ids, parts)

    return vectors.mapInArrow(run, SCHEMA)


def _decoded(batch: pa.RecordBatch, i: int) -> tuple[pa.Array, list[tuple[int, np.ndarray, np.ndarray]]]:
    ids = batch.column(0).slice(i, 1).flatten()
    layout = batch.column(1).slice(i, 1).flatten().to_numpy().reshape(-1, 3).tolist()
    entries = np.frombuffer(batch.column(2)[i].as_buffer(), "<i4").astype(np.int64)
    codes = np.frombuffer(batch.column(3)[i].as_buffer(), "<u2").reshape(len(layout), len(ids))
    blocks, at = [], 0
    for (lo, width, n), c in zip(layout, codes, strict=True):
        blocks.append((lo, entries[at:at + n * width].reshape(n, width), c))
        at += n * width
    return ids, blocks


def _nearest(blocks: list[tuple[int, np.ndarray, np.ndarray]], centroids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's cluster and squared distance; of equal distances the smaller number wins."""
    total = np.zeros((n, len(centroids)), np.int64)
    for lo, values, codes in blocks:
        away = values[:, None, :] - centroids[None, :, lo:lo + values.shape[1]]
        total += (away * away).sum(axis=2)[codes]  # an entry's distances, computed once
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(n), cluster]


def _sums(parts: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, n, sums): vectors and component sums of each cluster, one row for each cluster and task."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, blocks = _decoded(batch, i)
                cluster, _ = _nearest(blocks, centroids, len(ids))
                count += np.bincount(cluster, minlength=k)
                for lo, values, codes in blocks:
                    m, width = values.shape
                    met = np.bincount(cluster * m + codes, minlength=k * m).reshape(k, m)
                    sums[:, lo:lo + width] += met @ values
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(count), pa.array(list(sums))],
                                         names=["cluster", "n", "sums"])

    return parts.mapInArrow(run, "cluster int, n long, sums array<long>")


def first_centroids(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors with the smallest sha256 of the salted id, in that order."""
    by = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(r["v"]) for r in vectors.withColumn("_h", by).orderBy("_h", "v").limit(k).select("v").collect()]


def cluster(vectors: DataFrame, *, k: int, rounds: int, dims: int, salt: str) -> Clustering:
    """Assign every (id, v) to one of k centroids after ``rounds`` rounds of assigning and averaging."""
    parts = staged(segments(vectors, dims))
    centroids = np.array(first_centroids(vectors, k, salt), np.int64).reshape(-1, dims)
    for _ in range(rounds if len(centroids) else 0):
        cells = _sums(parts, centroids).select("cluster", "n", F.posexplode("sums").alias("dim", "s"))
        rows = cells.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
        for r in rows:  # k * dims numbers
            if r["n"]:
                centroids[r["cluster"], r["dim"]] = int(r["s"]) // r["n"]
    final = centroids.copy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, blocks = _decoded(batch, i)
                at, away = _nearest(blocks, final, len(ids))
                yield pa.RecordBatch.from_arrays([ids, pa.array(at.astype(np.int32)), pa.array(away)],
                                                 names=["id", "cluster", "distance"])

    return Clustering(staged(parts.mapInArrow(run, "id long, cluster int, distance long")), final.tolist())


def inertias(assigned: DataFrame) -> DataFrame:
    """(cluster, cluster_inertia, inertia): summed distances of each cluster and of all (as many rows as clusters)."""
    per = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    rows = per.collect()
    total = sum(int(r["s"]) for r in rows)
    return assigned.sparkSession.createDataFrame([(r["cluster"], int(r["s"]), total) for r in rows],
                                                 "cluster int, cluster_inertia long, inertia long")

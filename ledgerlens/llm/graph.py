"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import staged

MAX_ROUNDS = 60


class Forest:
    """Union-find over positions within one task; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.up = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def _roots(self) -> np.ndarray:
        up = self.up
        while True:
            nxt = up[up]
            if (nxt == up).all():
                self.up = up
                return up
            up = nxt

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the trees of a[i] and b[i] for every i."""
        while len(a):
            up = self._roots()
            ra, rb = up[a], up[b]
            apart = np.flatnonzero(ra != rb)
            if not len(apart):
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            hi, lo = np.maximum(ra, rb), np.minimum(ra, rb)
            # One link for each higher root in a round: no circle can arise.
            _, first = np.unique(hi, return_index=True)
            self.up[hi[first]] = lo[first]
            self.links.extend(zip(a[first].tolist(), b[first].tolist(), strict=True))


def _star(edges: DataFrame, by: str) -> DataFrame:
    """``edges`` with each centre's smallest neighbour ``m``; joined, so that a hub's rows can be split."""
    least = edges.groupBy(by).agg(F.min("v").alias("m"))
    return edges.join(least, by)


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    star = _star(both, "u").withColumn("m", F.least("u", "m"))
    return star.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    star = _star(down, "u")
    links = star.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return links.unionByName(star.where("v = m").select("u", "v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (u long, v long).

    Loops and repeated edges are harmless; nulls are dropped; an empty table gives
    an empty one. Each round is written to the shared checkpoint folder in place of the last one; the
    driver sees only a count and a checksum of the edges.
    """
    cur = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u <> v").distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now[0] == 0 or now == before:
            break
        before = now
        cur = staged(_small(_large(cur)), instead_of=cur)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = cur.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

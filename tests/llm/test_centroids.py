"""Dictionary-encoded k-means against plain loops."""

import hashlib
import math

import numpy as np
import pytest
from ledgerlens.llm import centroids
from pyspark.sql import functions as F


def plain(rows, k, rounds, salt):
    rows = sorted(rows, key=lambda r: (hashlib.sha256(f"{salt}{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in rows[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cents))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in rows]
        for i in range(len(cents)):
            if mine := [v for (_, v), a in zip(rows, at) if a == i]:
                cents[i] = [sum(c) // len(mine) for c in zip(*mine)]
    return sorted((str(r), *nearest(v)[::-1]) for r, v in rows), cents


@pytest.mark.parametrize("segment", [7, 16_384])
def test_clusters_equal_plain_loops(spark, segment, monkeypatch):
    monkeypatch.setattr(centroids, "SEGMENT", segment)
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(120, 10)).round(2)
    vecs[40:80] = vecs[3]  # many copies
    rows = [(i, v.tolist()) for i, v in enumerate(vecs)] + [(None, vecs[5].tolist()), (7, vecs[9].tolist())]
    bad = [(900, None), (901, [1.0] * 9), (902, [None] + [0.0] * 9), (903, [math.nan] * 10), (904, [math.inf] + [0.0] * 9)]
    df = spark.createDataFrame(rows + bad, "vec_id long, e array<double>").withColumn("cluster", F.lit("clash"))
    ints = centroids.integer_vectors(df, id_col="vec_id", vec_col="e", dims=10, scale=64)
    got = centroids.cluster(ints, k=5, rounds=4, dims=10, salt="3:")
    want, cents = plain([(i, [math.floor(64 * x) for x in v]) for i, v in rows], 5, 4, "3:")
    found = sorted((str(r.id), r.cluster, r.distance) for r in got.assigned.collect())
    assert found == want and got.centroids == cents
    sums = {r.cluster: r for r in centroids.inertias(got.assigned).collect()}
    assert all(r.inertia == sum(w[2] for w in want) for r in sums.values())
    assert all(sums[c].cluster_inertia == sum(w[2] for w in want if w[1] == c) for c in sums)


def test_blocks_are_lossless_and_shared():
    rng = np.random.default_rng(0)
    x = np.vstack([np.tile(rng.integers(-9, 9, (3, 12)), (20, 1)), rng.integers(-9, 9, (1, 12))])
    blocks = centroids.encode_blocks(x)
    assert {v.shape[1] for _, v, _ in blocks} == {8, 4}  # copies keep wide blocks
    for noise in (x, rng.integers(-(1 << 27), 1 << 27, (50, 12))):
        back = np.empty_like(noise)
        for lo, values, codes in centroids.encode_blocks(noise):
            back[:, lo:lo + values.shape[1]] = values[codes]
        assert (back == noise).all()


def test_few_rows_none_and_large(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, e array<float>")
    def go(d):
        return centroids.cluster(centroids.integer_vectors(d, id_col="vec_id", vec_col="e", dims=2, scale=4),
                                 k=8, rounds=2, dims=2, salt="3:")

    got = go(df)
    assert sorted((r.id, r.cluster, r.distance) for r in got.assigned.collect()) == [(1, 0, 0), (2, 0, 0)]
    none = go(df.limit(0))
    assert none.assigned.collect() == [] and centroids.inertias(none.assigned).collect() == []
    with pytest.raises(Exception, match="do not fit a long"):
        go(df.unionByName(spark.createDataFrame([(3, [1e9, 0.0])], "vec_id long, e array<float>")))

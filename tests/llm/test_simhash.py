"""SimHash fingerprints, tree and groups against brute force."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgerlens.llm import graph, queries, simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    k = min(3, len(words))
    shingles = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_groups(rows, bits=2):
    """Smallest id reachable, for (id, fingerprint) pairs."""
    low = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(len(rows)):
                if low[b] < low[a] and bin(rows[a][1] ^ rows[b][1]).count("1") <= bits:
                    low[a], changed = low[b], True
    return low


def near_set(n, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    near = base[:n // 4].copy()
    for _ in range(2):
        near ^= np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64)
    hot = np.full(n // 8, base[5])
    for _ in range(4):
        hot ^= np.uint64(1) << rng.integers(0, 64, len(hot)).astype(np.uint64)
    out = np.unique(np.concatenate([base, near, hot]))
    rng.shuffle(out)
    return out


def roots(n, pairs):
    f = graph.Forest(n)
    f.link(np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int))
    return f._roots().tolist()


def test_shards_find_what_all_pairs_find():
    f = near_set(4000)
    pairs = [(i, j) for i in range(len(f)) for j in (np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= 2) + i + 1).tolist()]
    want = roots(len(f), pairs)
    assert roots(len(f), simhash.shard_links(f, len(f), 2)) == want
    tree, found, members = simhash.dealing_tree(f[:1000], 60), [], 0
    for _, mine, other in simhash.route(tree, f, 2):
        at = np.concatenate([mine, other])
        members += len(mine)
        got = simhash.shard_links(f[at], len(mine), 2)
        assert len(got) < len(at)  # a forest
        found += [(int(at[a]), int(at[b])) for a, b in got]
    assert members == len(f) and roots(len(f), found) == want


def test_fingerprints_of_edge_texts():
    for t in ["", " \t\n", "one", "One two", "a b c", "É é ABC x\x0by\x0cz", "w " * 3000, "a b c a b c a b c"]:
        assert simhash.fingerprint_text(t.encode(), 3) == brute_fingerprint(t), t


def test_query_matches_brute_force(spark, sf):
    got = queries.op9_simhash_near_dedup(spark, sf).collect()
    src = sorted((r.doc_id, brute_fingerprint(r.text)) for r in
                 spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    low = brute_groups(src)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == [
        (i, f"{f:016x}", c) for (i, f), c in zip(src, low, strict=True)]


def test_edge_rows(spark, docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    zero = {r.id: r.component_id for r in got if r.fp == 0}
    assert zero == {2: 2, 3: 2, 4: 2}  # null, empty and blank texts are one group
    assert [r.component_id for r in got if r.id == 1] == [1, 1]
    assert [r.component_id for r in got if r.id is None] == [None]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_keep_first_keeps_columns_and_one_row_of_a_group(spark, docs):
    clash = docs.withColumn("row", F.lit("r")).withColumn("fp", F.lit("f"))
    kept = simhash.keep_first(clash)
    assert kept.schema.names == clash.schema.names
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect())
    assert ids == [-1, 1, 2, 5, 6, 7, 8]
    assert simhash.keep_first(clash.limit(0)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 200), (200, 300)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = dict(map(tuple, graph.components(df).collect()))
    assert {got[i] for i in range(41)} == {0} and {got[100 + i] for i in range(60)} == {100}
    assert got[300] == got[200] == 200
    assert graph.components(df.limit(0)).count() == 0


def test_staged_tables_go_once_replaced(spark):
    import os
    from urllib.parse import urlparse

    from ledgerlens.llm.common import drop_staged, staged

    one = staged(spark.range(5))
    two = staged(one.where("id > 1"), instead_of=one)
    assert not os.path.exists(urlparse(one._staged_at).path) and sorted(r.id for r in two.collect()) == [2, 3, 4]
    drop_staged(spark.range(3))  # not a staged table
    again = staged(two, instead_of=spark.range(1))
    assert two.count() == again.count() == 3

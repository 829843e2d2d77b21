"""Mergeable sketches (F3, F5, F8) against exact values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import profile, sketches


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    data = [(int(i), f"v{i % 700}", float(x), i % 3, None if i % 5 else 1.5) for i, x in enumerate(rng.normal(100, 15, 6000))]
    data += [(None, None, None, 0, None), (1, "", math.nan, 1, math.nan)]
    return spark.createDataFrame(data, "id long, name string, x double, part int, thin double").repartition(4)


def test_all_columns_in_one_scan(rows):
    s = sketches.column_sketches(rows, ["id", "name", "x", "thin"])
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Expand" not in plan
    got = {r.column_name: r for r in s.collect()}
    assert (got["x"].n, got["x"].n_null) == (6000, 2) and got["name"].quantiles is None and got["name"].min is None


def test_united_parts_equal_one_sketch_within_bounds(rows, spark, tmp):
    parts = sketches.column_sketches(rows, ["id", "name", "x"], by=["part"])
    parts.where("part = 0").write.mode("append").parquet(f"{tmp}/s")
    parts.where("part > 0").write.mode("append").parquet(f"{tmp}/s")
    one = sketches.unite(spark.read.parquet(f"{tmp}/s"))
    exact = {r.column_name: r.n_unique for r in profile.n_unique(rows, ["id", "name"]).collect()}
    for r in sketches.n_unique_of(one).where("column_name <> 'x'").collect():
        assert abs(r.n_unique - exact[r.column_name]) <= 4 * sketches.distinct_error() * exact[r.column_name]
    x = np.sort([r.x for r in rows.select("x").where("x IS NOT NULL AND NOT isnan(x)").collect()])
    for r in sketches.quantiles_of(one, [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]).where("column_name = 'x'").collect():
        lo, hi = np.searchsorted(x, r.value, "left") / len(x), np.searchsorted(x, r.value, "right") / len(x)
        assert lo - 2 * sketches.rank_error() <= r.p <= hi + 2 * sketches.rank_error()
    d = sketches.describe_of(one).where("column_name = 'x'").first()
    assert (d["count"], d["min"], d["max"]) == (len(x), x[0], x[-1])
    assert d["mean"] == pytest.approx(x.mean()) and d["std"] == pytest.approx(x.std(ddof=1))


def test_union_by_group_and_again(rows):
    parts = sketches.column_sketches(rows, ["x", "name"], by=["part"])
    twice = sketches.unite(sketches.unite(parts.unionByName(parts), by=["part"]))
    once = sketches.unite(parts)
    a = {r.column_name: r.n_unique for r in sketches.n_unique_of(twice).collect()}
    assert a == {r.column_name: r.n_unique for r in sketches.n_unique_of(once).collect()}  # copies add nothing


def test_empty_tables_and_null_columns(rows):
    none = sketches.column_sketches(rows.limit(0), ["id", "x"])
    assert [(r.n, r.n_null) for r in none.collect()] == [(0, 0), (0, 0)]
    assert sketches.quantiles_of(none, [0.5]).collect() == [] and sketches.describe_of(sketches.unite(none)).collect() == []
    assert {r.n_unique for r in sketches.n_unique_of(sketches.unite(none)).collect()} == {0}
    nulls = sketches.column_sketches(rows.select(F.lit(None).cast("double").alias("z")))
    assert [(r.n, r.n_null, r.quantiles) for r in nulls.collect()] == [(0, 6002, None)]


def test_box_stats_from_stored_quartiles(rows, spark):
    x = rows.where("x IS NOT NULL AND NOT isnan(x)")
    d = sketches.describe_of(sketches.column_sketches(x, ["x"])).first()
    q = spark.createDataFrame([d], "column_name string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double")
    near, exact = profile.box_stats(x, "x", quartiles=q).first(), profile.box_stats(x, "x").first()
    assert (near.q1, near["median"], near.q3) == (d.q25, d.q50, d.q75)
    assert abs(near["median"] - exact["median"]) < 2 and abs(near.n_outliers - exact.n_outliers) < 40

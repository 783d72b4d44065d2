"""The stored point index against fresh joins."""

import random

import brute
import pytest
from pyspark.sql import functions as F

import tessera as ts
from tessera.operators import index as stored
from tessera.plans import skew, tiles


def spread(n, seed, ids=0):
    rng = random.Random(seed)
    return [(ids + i, 1.0, 1.0) if i % 3 == 0 else (ids + i, rng.uniform(0, 30), rng.uniform(0, 30)) for i in range(n)]


def pairs(df):
    return sorted((r["src"], r["dst"], r["dist"]) for r in df.collect())


@pytest.mark.parametrize("salted", [False, True])
def test_searches_equal_fresh_joins(spark, points, monkeypatch, tmp_path, salted):
    monkeypatch.setattr(stored, "BLOCK_TILES", 2)
    monkeypatch.setattr(tiles, "TOP", 4)
    if salted:
        monkeypatch.setattr(tiles, "BUSY", 1)
        monkeypatch.setattr(skew, "HOT_SHARE", 4)
    held = spread(2500, 1) + [(7, 1.5, 1.0)] * 20
    path = str(tmp_path / "index")
    ts.build_index(points(held), path)
    index = ts.open_index(spark, path)
    assert len(index.counts) > 2 and index.rows.count() == len(held)
    for queries, radius, itself in ((spread(40, 2, 5000), 1.5, False), (held[:200], 0.5, True)):
        want = sorted(p for p in brute.pairs(queries, held, exclude_self=itself) if p[2] <= radius)
        assert pairs(ts.radius_search(index, points(queries), radius, itself)) == want
        assert pairs(ts.radius_join(points(queries), points(held), radius, itself)) == want


def test_a_search_reads_its_blocks_only(spark, points, monkeypatch):
    monkeypatch.setattr(stored, "BLOCK_TILES", 2)
    held = spread(2500, 3)
    index = ts.build_index(points(held))
    every = {r["block"] for r in index.rows.select("block").distinct().collect()}
    corner = points([(1, 29.0, 29.0)])
    blocks = ts.blocks_reached(index, corner, 1.0)
    assert set(blocks) < every and 4 * index.within(blocks).count() < len(held)
    assert set(ts.blocks_reached(index, points(held), 1.0)) == every
    found = ts.radius_search(index, corner, 1.0)
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [block" in plan or "PartitionFilters: [isnotnull(block" in plan
    assert pairs(found) == sorted(p for p in brute.pairs([(1, 29.0, 29.0)], held, False) if p[2] <= 1.0)


def test_odd_points_and_queries(spark, points):
    held = [(1, 0.0, -0.0), (2, float("nan"), 0.0), (None, 0.0, 0.0), (3, None, 0.0), (4, float("inf"), 0.0), (1, -0.0, 0.0)]
    extra = points(held).withColumn("block", F.lit("clash")).withColumn("tile", F.lit("clash"))
    index = ts.build_index(extra)
    assert index.n_rows == 3
    found = ts.radius_search(index, extra, 0.0).collect()
    assert sorted(((r["src"], r["dst"]) for r in found), key=str) == sorted(
        [(a, b) for a in (1, 1, None) for b in (1, 1, None)], key=str
    )
    assert ts.radius_search(index, points([]), 1.0).count() == 0
    nothing = ts.build_index(points([]))
    assert ts.radius_search(nothing, points(held), 1.0).count() == 0
    with pytest.raises(ValueError):
        ts.radius_search(index, extra, -1.0)

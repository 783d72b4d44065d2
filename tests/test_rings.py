import math
import random

import brute
import pytest
from pyspark.sql import functions as F

import tessera as ts
from tessera.operators import rings
from tessera.plans import skew, tiles


def test_stats_and_replicas(points):
    df = points([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 2.0, 0.0), (4, 4.0, 0.0)])
    stat = ts.point_stats(df, 1).first()
    assert tuple(stat) == (4, 4, 0.0, 16.0, 4.0)
    for boundary in ("fraction", "relative"):
        got = {(r.id, r.ring) for r in ts.ring_replicas(df, 1, boundary=boundary).collect()}
        assert got == {(1, 0), (2, 0), (3, 0), (3, 1), (4, 3), (4, 4)}
        near = brute.rows(ts.knn_ring(df, 1, boundary=boundary))
        assert near == {(1, 2, 1.0, 1), (2, 1, 1.0, 1), (3, 2, 1.0, 1)}
    kept = {(r.src, r.dst) for r in ts.knn_ring(df, 1, keep_empty=True).collect()}
    assert (4, None) in kept and len(kept) == 4
    exact = brute.rows(ts.knn_exact(df, k=1))
    assert exact == near | {(4, 3, 2.0, 1)}


def ring_pairs(data, k, rings=None, boundary="fraction"):
    keys = [x * x + y * y for _, x, y in data]
    low, rings = min(keys), rings or max(1, len(data) // k)
    width = (max(keys) - low) / rings
    members = {}
    for row, key in zip(data, keys):
        at = [0]
        if width > 0:
            home = math.floor((key - low) / width)
            fr = math.fmod(key - low, width) if boundary == "fraction" else (key - low) / width
            fr -= math.floor(fr)
            at = [home] + [home - 1] * (fr < 0.3 and home > 0) + [home + 1] * (fr > 0.7)
        for ring in at:
            members.setdefault(ring, []).append(row)
    return [p for rows in members.values() for p in brute.pairs(rows, rows)]


@pytest.mark.parametrize("boundary", ["fraction", "relative"])
@pytest.mark.parametrize("n_rings", [None, 3])
def test_equals_pairs_of_shared_rings(points, boundary, n_rings):
    rng = random.Random(11)
    data = [(i, rng.uniform(-9, 9), rng.uniform(0, 40)) for i in range(250)]
    data += [(i + 1000, 3.0, 4.0) for i in range(125)]
    got = ts.knn_ring(points(data), 4, n_rings, boundary, unique_ids=True)
    assert brute.rows(got) == brute.top_k(ring_pairs(data, 4, n_rings, boundary), 4)


def test_ring_distances_are_never_below_exact(points):
    rng = random.Random(12)
    data = [(i, rng.uniform(0, 50), rng.uniform(0, 50)) for i in range(400)]
    exact = {(s, rk): d for s, _, d, rk in brute.rows(ts.knn_exact(points(data), k=5))}
    for src, _, dist, rk in brute.rows(ts.knn_ring(points(data), 5)):
        assert dist >= exact[src, rk]


def test_ties_all_repeated_ids(points):
    rng = random.Random(13)
    data = [(rng.randrange(40), float(rng.randrange(9)), float(rng.randrange(9))) for _ in range(200)]
    got = ts.knn_ring(points(data), 4, ties="all")
    assert brute.rows(got) == brute.top_k(ring_pairs(data, 4), 4, "all")


def test_keys_compare_as_numbers(points):
    df = points([(1, 3.0, 0.0), (2, 10.0, 0.0), (3, 31.0, 0.0)])
    stat = ts.point_stats(df, 1).first()
    assert (stat.min_key, stat.max_key) == (9.0, 961.0)


@pytest.mark.parametrize(
    "data",
    [[], [(1, 1.0, 1.0)], [(i, 2.0, 2.0) for i in range(20)], [(1, float("nan"), 0.0), (2, 1.0, 1.0)]],
    ids=["empty", "one", "identical", "nan"],
)
def test_degenerate(points, data):
    got = brute.rows(ts.knn_ring(points(data), 3))
    if len(data) < 2:
        assert got == set()
    elif len(data) == 2:
        assert got == {(1, 2, "NaN", 1), (2, 1, "NaN", 1)}
    else:
        assert got == {(i, 0 if i else 1, 0.0, 1) for i in range(20)}


def test_bad_boundary(points):
    with pytest.raises(ValueError):
        ts.ring_assign(points([(1, 0.0, 0.0)]), boundary="other")


def test_odd_rows_leave_the_rings_of_others(points):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(21)
    data = [(i, rng.uniform(0, 50), rng.uniform(0, 50)) for i in range(120)]
    odd = [(900, nan, 1.0), (901, 1.0, inf), (902, None, 2.0), (903, -inf, nan), (904, 1e200, 1e200)]
    plain = {(r.id, r.home) for r in ts.ring_assign(points(data)).collect()}
    mixed = {(r.id, r.home) for r in ts.ring_assign(points(data + odd)).collect()}
    assert {r for r in mixed if r[0] < 900} == plain
    assert {r for r in mixed if r[0] >= 900} == {(900, None), (901, None), (903, None), (904, None)}
    assert tuple(ts.point_stats(points(data + odd)).first()) == tuple(ts.point_stats(points(data)).first())
    near = {r for r in brute.rows(ts.knn_ring(points(data + odd), 4)) if r[0] < 900 and r[2] != "NaN"}
    assert near == brute.rows(ts.knn_ring(points(data), 4))


@pytest.mark.parametrize("small", [4, 64, 10_000])
def test_small_and_large_rings_agree(points, monkeypatch, small):
    monkeypatch.setattr(rings, "SMALL_RING", small)
    rng = random.Random(22)
    data = [(i, rng.uniform(0, 9), rng.uniform(0, 9)) for i in range(200)] + [(i + 500, 1.0, 1.0) for i in range(80)]
    assert brute.rows(ts.knn_ring(points(data), 4)) == brute.top_k(ring_pairs(data, 4), 4)


def test_a_ring_with_a_third_of_all_points_is_dealt_out(points, monkeypatch):
    """Sizes reach the rows of a large ring through salts; the result stays that of all pairs in it."""
    monkeypatch.setattr(rings, "HOT_RING", 16)
    monkeypatch.setattr(skew, "HOT_SHARE", 4)
    rng = random.Random(11)
    angles = [rng.uniform(0, 6.28) for _ in range(60)]
    data = [(i, math.cos(a) * 50, math.sin(a) * 50) for i, a in enumerate(angles)]
    data += [(100 + i, rng.uniform(-70, 70), rng.uniform(-70, 70)) for i in range(120)]
    df = points(data)
    want = brute.rows(ts.knn_ring(df, 4, unique_ids=True))
    monkeypatch.setattr(rings, "HOT_RING", 1 << 14)
    assert brute.rows(ts.knn_ring(df, 4, unique_ids=True)) == want


def test_partitions_are_bounded_by_the_session(points, monkeypatch):
    monkeypatch.setattr(tiles, "ROWS_PER_TASK", 2)
    monkeypatch.setattr(tiles, "TASKS_PER_PARTITION", 3)
    df = points([(i, float(i % 37), float(i % 11)) for i in range(400)])
    rows = df.withColumn("g", F.lit(0).cast("long"))
    packed = tiles.pack(rows, 400, tiles.Box(0.0, 36.0, 0.0, 10.0), 32, tiles.Plane(), tie_break=["id"])
    assert packed.tasks == 3 * 4 and packed.n_rows == 400
    assert sorted(r["rank"] for r in packed.rows.select("rank").collect()) == list(range(400))

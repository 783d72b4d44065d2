import math
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import tessera as ts
from tessera.plans import nearest, skew, tiles, vector_kernel, window_bound

FIVE = [(1, 0, 0), (2, 3, 4), (3, 6, 8), (4, 0, 5), (5, 0, 0)]
FIVE = [(i, float(x), float(y)) for i, x, y in FIVE]


def clustered(n, seed):
    """A dense clump, a crowded place, a lattice and scattered points."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = i % 4
        if kind == 0:
            out.append((i, 5 + rng.random() * 1e-6, 7 + rng.random() * 1e-6))
        elif kind == 1:
            out.append((i, 1.0, 2.0))
        elif kind == 2:
            out.append((i, float(rng.randrange(12)), float(rng.randrange(12))))
        else:
            out.append((i, rng.uniform(-1000, 1000), rng.uniform(-20, 20)))
    return out


def test_ties(points):
    s10, s45 = 10**0.5, 45**0.5
    df = points(FIVE)
    want = {
        1: [(5, 0.0), (2, 5.0), (3, 10.0)],
        2: [(4, s10), (1, 5.0)],
        3: [(2, 5.0), (4, s45), (1, 10.0)],
        4: [(2, s10), (1, 5.0), (3, s45)],
        5: [(1, 0.0), (2, 5.0), (3, 10.0)],
    }
    flat = {(src, d, x, rk) for src, near in want.items() for rk, (d, x) in enumerate(near, 1)}
    assert brute.rows(ts.knn_exact(df, k=3, unique_ids=True)) == flat
    want = {
        1: [(5, 0.0), (2, 5.0), (4, 5.0)],
        2: [(4, s10), (1, 5.0), (3, 5.0)],
        3: [(2, 5.0), (4, s45), (1, 10.0)],
        4: [(2, s10), (1, 5.0), (5, 5.0)],
        5: [(1, 0.0), (2, 5.0), (4, 5.0)],
    }
    flat = {(src, d, x, rk) for src, near in want.items() for rk, (d, x) in enumerate(near, 1)}
    assert brute.rows(ts.knn_exact(df, k=3, ties="all")) == flat


def test_first_coordinate_only(points):
    got = brute.rows(ts.knn_lat_only(points(FIVE), 2))
    assert got == {
        (1, 1, 0.0, 1), (1, 2, 3.0, 2),
        (2, 2, 0.0, 1), (2, 1, 3.0, 2),
        (3, 3, 0.0, 1), (3, 2, 3.0, 2),
        (4, 1, 0.0, 1), (4, 2, 3.0, 2),
        (5, 1, 0.0, 1), (5, 2, 3.0, 2),
    }


@pytest.mark.parametrize("ties", ["distinct", "all"])
@pytest.mark.parametrize("exclude_self", [True, False])
def test_clustered_data_equals_full_comparison(points, ties, exclude_self):
    data = clustered(600, 3)
    got = ts.knn_exact(points(data), k=4, ties=ties, exclude_self=exclude_self, unique_ids=True)
    want = brute.top_k(brute.pairs(data, data, exclude_self), 4, ties)
    assert brute.rows(got) == want


def test_repeated_ids_and_rows(points):
    rng = random.Random(5)
    data = [(rng.choice([1, 1, 1, rng.randrange(60)]), float(rng.randrange(30)), rng.random()) for _ in range(300)]
    data += data[:100] + [data[0]] * 100
    for ties in ("distinct", "all"):
        want = brute.top_k(brute.pairs(data, data), 5, ties)
        assert brute.rows(ts.knn_exact(points(data), k=5, ties=ties)) == want


def test_two_sides(points):
    r, s = clustered(120, 1), [(i + 1000, x + 0.25, y) for i, x, y in clustered(300, 2)]
    s += r[:40]
    for exclude_self in (True, False):
        got = ts.knn_exact(points(r), points(s), 6, exclude_self=exclude_self)
        assert brute.rows(got) == brute.top_k(brute.pairs(r, s, exclude_self), 6)


def test_salted_paths_give_the_same(points, monkeypatch):
    monkeypatch.setattr(tiles, "BUSY", 2)
    monkeypatch.setattr(nearest, "CROWD", 20)
    monkeypatch.setattr(skew, "HOT_SHARE", 8)
    r, s = clustered(300, 8), [(i + 1000, x, y) for i, x, y in clustered(200, 9)]
    got = ts.knn_exact(points(r), points(s), 3)
    assert brute.rows(got) == brute.top_k(brute.pairs(r, s), 3)
    got = ts.knn_exact(points(r), None, 3, unique_ids=True)
    assert brute.rows(got) == brute.top_k(brute.pairs(r, r), 3)


@pytest.mark.parametrize(
    "data",
    [
        [],
        [(1, 2.0, 3.0)],
        [(i, 1.5, 1.5) for i in range(70)],
        [(i, float(i), 0.0) for i in range(100)],
        [(i, float(i), 2.0 * i) for i in range(100)],
        [(i, float(i % 12), float(i // 12)) for i in range(144)],
        [(1, 0.0, 0.0), (1, 5.0, 5.0)],
        [(1, 1e300, 0.0), (2, -1e300, 1.0), (3, 0.0, 5e-324)],
        [(1, -0.0, 0.0), (2, 0.0, -0.0), (3, 1.0, 1.0)],
    ],
    ids=["empty", "one", "identical", "line", "diagonal", "lattice", "one-id", "extreme", "zeros"],
)
def test_degenerate_inputs(points, data):
    want = brute.top_k(brute.pairs(data, data), 3)
    assert brute.rows(ts.knn_exact(points(data), k=3)) == want


def test_nan_sorts_last_and_null_takes_no_part(points):
    nan = float("nan")
    data = [(1, 0.0, 0.0), (2, 1.0, 0.0), (3, nan, 0.0), (4, 2.0, nan)]
    got = brute.rows(ts.knn_exact(points([*data, (9, None, 1.0)]), k=3))
    found = [(a, b, d) for a, b, d in brute.pairs(data, data) if a != b]
    assert got == brute.top_k(found, 3)


def test_string_ids(points):
    data = [(f"p{i:03d}", x, y) for i, x, y in clustered(80, 4)]
    got = ts.knn_exact(points(data, "string"), k=2)
    assert brute.rows(got) == brute.top_k(brute.pairs(data, data), 2)


def test_large_k(points):
    data = clustered(150, 6)
    got = ts.knn_exact(points(data), k=40, ties="all")
    assert brute.rows(got) == brute.top_k(brute.pairs(data, data), 40, "all")


def test_vectors(spark):
    rng = random.Random(2)
    data = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(200)]
    data += [(i + 500, list(v)) for i, v in data[:30]]
    df = spark.createDataFrame(data, "id bigint, v array<double>")
    for m in (1, 4, 6):

        def dist(a, b):
            total = 0.0
            for p, q in zip(a[1][:m], b[1][:m]):
                total += (p - q) * (p - q)
            return total**0.5

        found = [(a[0], b[0], dist(a, b)) for a in data for b in data if a[0] != b[0]]
        assert brute.rows(ts.knn_vec(df, None, 3, m, unique_ids=True)) == brute.top_k(found, 3)


def test_odd_vectors(spark):
    nan = float("nan")
    data = [(1, [0.0, 0.0, 9.0]), (2, [3.0, 4.0]), (3, [nan, 1.0]), (4, [1.0]), (5, [1.0, None]), (6, None)]
    df = spark.createDataFrame(data, "id bigint, v array<double>")
    assert brute.rows(ts.knn_vec(df, None, 2, 2)) == {
        (1, 2, 5.0, 1), (1, 3, "NaN", 2), (2, 1, 5.0, 1), (2, 3, "NaN", 2), (3, 1, "NaN", 1),
    }


def test_no_nested_loop_join_between_points(spark, points):
    df = points(clustered(3000, 7))
    for result in (ts.knn_exact(df, k=5), ts.knn_ring(df, 5), ts.radius_join(df, None, 1.0)):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
        assert "tile" in plan


def test_group_limit_runs_before_the_shuffle(spark, points):
    df = points(FIVE).select(F.col("id").alias("src"), F.col("id").alias("dst"), F.col("x").alias("dist"))
    plan = ts.top_k(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_bad_arguments(points):
    with pytest.raises(ValueError):
        ts.knn_exact(points(FIVE), k=0)
    with pytest.raises(ValueError):
        ts.knn_exact(points(FIVE), ties="some")
    with pytest.raises(ValueError):
        ts.knn_exact(points(FIVE), axes="y")


@pytest.mark.parametrize("m", [8, 16, 64])
@pytest.mark.parametrize("seed", [1, 2])
def test_vectors_with_many_equal_distances(spark, m, seed):
    """Sums in another order than Spark's differ in their last bits; no neighbour may get lost by that."""
    rng = random.Random(seed)
    data = [(i, [rng.choice([0.1, 0.2, 0.3, 0.7]) for _ in range(m)]) for i in range(60)]
    df = spark.createDataFrame(data, "id bigint, v array<double>")

    def dist(a, b):
        total = 0.0
        for p, q in zip(a, b):
            total += (p - q) * (p - q)
        return math.sqrt(total)

    found = [(a, b, dist(v, w)) for a, v in data for b, w in data if a != b]
    for k, ties in ((1, "distinct"), (5, "distinct"), (5, "all"), (20, "distinct")):
        got = ts.knn_vec(df, None, k, m, ties=ties, unique_ids=True)
        assert brute.rows(got) == brute.top_k(found, k, ties)


def test_bounds_never_fall_below_the_kth_distance():
    rng = np.random.default_rng(4)
    groups = np.sort(rng.integers(0, 30, 700))
    rows = rng.integers(0, 6, (700, 3)) / 10
    for width in (64, 128):
        starts = window_bound._starts(groups, width)
        assert set((starts[:, None] + np.arange(width)).ravel()) == set(range(700))
    batch = pa.RecordBatch.from_pydict({"g": groups, "x": rows[:, 0], "y": rows[:, 1]})
    (out,) = window_bound.add_bound(3, ["x", "y"])(iter([batch]))
    bound = out.column("bound").to_numpy()
    for g in range(30):
        own = rows[groups == g][:, :2]
        dist = np.sqrt(((own[:, None] - own[None]) ** 2).sum(-1))
        for i, found in enumerate(bound[groups == g]):
            near = np.unique(np.round(np.delete(dist[i], i), 9))
            if len(own) <= 64 and len(near) >= 3:
                assert found >= near[2] - 1e-9 and np.isfinite(found)


def test_bound_memory_does_not_grow_with_the_window(monkeypatch):
    monkeypatch.setattr(window_bound, "AT_ONCE", 1000)
    rng = np.random.default_rng(5)
    points = rng.random((2, 90, 2))
    groups = np.zeros((2, 90), int)
    small = window_bound._kth_distinct(groups, points, 7)
    monkeypatch.setattr(window_bound, "AT_ONCE", 1 << 22)
    assert (small == window_bound._kth_distinct(groups, points, 7)).all()


@pytest.mark.parametrize("extra", [0, 1, 2, 3])
def test_sources_beside_the_targets_have_finite_bounds(points, monkeypatch, extra):
    """A short last tile must not give its many sources infinite bounds."""
    rng = random.Random(extra)
    s = [(i, rng.random(), rng.random()) for i in range(256 + extra)]
    r = [(i + 5000, 5 + rng.random(), 5 + rng.random()) for i in range(300)]
    seen = []
    real = nearest.matches

    def watched(packed, bounds, *more):
        seen.append((bounds.where("bound = double('inf')").count(), tiles.tile_pairs(packed, bounds, more[0]).count()))
        return real(packed, bounds, *more)

    monkeypatch.setattr(nearest, "matches", watched)
    got = ts.knn_exact(points(r), points(s), 3, exclude_self=False, unique_ids=True)
    assert brute.rows(got) == brute.top_k(brute.pairs(r, s, False), 3)
    infinite, pairs = seen[0]
    # 18 source tiles and 8 target tiles; sources far away need some of the region's edge.
    assert infinite == 0 and pairs < 100


def test_few_vectors_are_compared_in_full(spark):
    """Of all pairs, few distances are computed over all coordinates; equal and large values lose nothing."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(700, 32)) * np.linspace(3, 0.1, 32)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(v)], "id bigint, v array<double>")
    work = ts.knn_vec(df, None, 5, 32, unique_ids=True, work=True).first()
    assert work["pairs"] == 700 * 700 and 700 * 5 <= work["whole"] < 0.05 * work["pairs"]


@pytest.mark.parametrize("distinct", [True, False])
def test_kernel_equals_all_distances(distinct):
    rng = np.random.default_rng(8)
    m = 24
    for scale, values in ((1.0, None), (1.0, [0.1, 0.2, 0.3]), (1e-160, None), (1e160, None), (1.0, [1e8, 1e8 + 1])):
        rows = (rng.normal(size=(300, m)) if values is None else rng.choice(values, size=(300, m))) * scale
        ranks = np.arange(300)
        order = rng.permutation(300)
        for bound in (np.inf, 2.0 * scale):
            found = vector_kernel.nearest(
                rows[:90], ranks[:90], np.full(90, bound), rows, ranks, order, 6, distinct, rows.mean(axis=0), np.eye(m)
            )
            got = {(i, j, d) for i, j, d in zip(*(x.tolist() for x in found[:3]))}
            want = set()
            with np.errstate(over="ignore"):
                for i in range(90):
                    near = sorted((float(vector_kernel.exact(rows[i : i + 1], rows[j : j + 1])[0]), order[j], j) for j in range(300) if j != i)
                    near = [n for n in near if n[0] <= bound]
                    if distinct:
                        near = [n for at, n in enumerate(near) if not at or n[0] != near[at - 1][0]]
                    want |= {(i, j, d) for d, _, j in near[:6]}
            assert got == want


def test_vectors_are_sent_once_per_block(spark, monkeypatch):
    """A row goes to one meeting per block of the other side, not per tile; answers are those of all pairs."""
    monkeypatch.setattr(tiles, "FEW_ROWS", 1)
    rng = np.random.default_rng(6)
    v = rng.normal(size=(2500, 6))
    v[::5] = np.round(v[::5])
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(v)], "id bigint, v array<double>")
    seen = []
    real = vector_kernel.search
    sent = spark.sparkContext.accumulator(0)

    def watched(*args):
        run = real(*args)

        def counted(sources, targets):
            sent.add(sources.num_rows + targets.num_rows)
            return run(sources, targets)

        return counted

    monkeypatch.setattr(tiles.vector_kernel, "search", watched)
    for ties in ("distinct", "all"):
        got = brute.rows(ts.knn_vec(df, None, 3, 6, ties=ties, unique_ids=True))
        seen.append(sent.value)
        want = []
        for i in range(0, len(v), 97):
            dist = vector_kernel.exact(np.repeat(v[i : i + 1], len(v), axis=0), v)
            near = sorted((float(d), j) for j, d in enumerate(dist) if j != i)
            if ties == "distinct":
                near = [n for at, n in enumerate(near) if not at or n[0] != near[at - 1][0]]
            want += [(i, j, d) for d, j in near[:3]]
        assert sorted(r[:3] for r in got if r[0] % 97 == 0) == sorted(want)
    # 10 blocks of 256 on either side; by tiles of 128 it was 20 times the rows and more.
    assert 0 < seen[0] <= 2 * 10 * len(v)


def test_points_are_sent_once_per_block(spark, points, monkeypatch):
    """A row goes to its block and to blocks beside it, and a source's candidates stay in that task."""
    monkeypatch.setattr(tiles, "PLANE_BLOCK", 1024)
    sent, kept = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    real = tiles.plane_kernel.search

    def watched(*args):
        run = real(*args)

        def counted(sources, targets):
            found = run(sources, targets)
            sent.add(sources.num_rows + targets.num_rows)
            kept.add(len(found.column("others").combine_chunks().flatten()))
            return found

        return counted

    monkeypatch.setattr(tiles.plane_kernel, "search", watched)
    rng = random.Random(5)
    data = [(i, rng.random(), rng.random()) for i in range(4000)]
    got = brute.rows(ts.knn_exact(points(data), None, 3, unique_ids=True))
    assert len(got) == 3 * len(data)
    want = brute.top_k(brute.pairs(data[::40], data), 3)
    assert {r for r in got if r[0] % 40 == 0} == want
    assert len(data) < sent.value <= 3 * len(data) and kept.value == 3 * len(data)


@pytest.mark.parametrize("reach", [1, 3])
def test_blocks_that_reach_many_others(points, monkeypatch, reach):
    """Such blocks meet one block at a time; a place alone in its reach and null or string ids lose nothing."""
    monkeypatch.setattr(tiles, "PLANE_BLOCK", 32)
    monkeypatch.setattr(tiles, "PLANE_REACH", reach)
    data = clustered(400, 11)
    data += [(i, 0.25, 0.25) for i, _, _ in data[:40]] + data[:30]
    got = ts.knn_exact(points(data), None, 4)
    assert brute.rows(got) == brute.top_k(brute.pairs(data, data), 4)
    # Points on a circle around one point: its neighbours are at one distance, so it has no bound.
    ring = [(i, float(x * s), float(y * t)) for i, (x, y, s, t) in enumerate(
        (x, y, s, t) for x, y in ((3, 4), (4, 3), (0, 5), (5, 0)) for s in (1, -1) for t in (1, -1)
    )] * 3 + [(99, 0.0, 0.0)] + [(i + 100, 1000.0 + i, 7.0) for i in range(200)]
    named = [(f"n{i}", x, y) for i, x, y in ring]
    assert brute.rows(ts.knn_exact(points(named, "string"), None, 3)) == brute.top_k(brute.pairs(named, named), 3)
    nameless = [(None, x, y) for _, x, y in data[:50]] + [(i, x + 0.001, y) for i, x, y in data]
    few = {(r.src, r.rk, r.dist) for r in ts.knn_exact(points(nameless), None, 4).collect()}
    monkeypatch.setattr(tiles, "PLANE_REACH", 1 << 20)
    monkeypatch.setattr(tiles, "PLANE_BLOCK", 1 << 13)
    assert few == {(r.src, r.rk, r.dist) for r in ts.knn_exact(points(nameless), None, 4).collect()}

import math
import random
from collections import Counter

import brute
import pytest
from check_oracle import entry
from pyspark.sql import functions as F

import tessera as ts
from tessera.operators import radius as radii
from tessera.operators import upsample as growing
from tessera.plans import skew, tiles

FIVE = [(1, 0.0, 0.0), (2, 3.0, 4.0), (3, 6.0, 8.0), (4, 0.0, 5.0), (5, 0.0, 0.0)]


def pairs(df):
    got = [(r.src, r.dst, r.dist) for r in df.collect()]
    return sorted(got)


def test_edge_is_inside(points):
    got = {}
    for src, dst, _ in pairs(ts.radius_join(points(FIVE), None, 5.0)):
        got.setdefault(src, set()).add(dst)
    assert got == {1: {1, 2, 4, 5}, 2: {1, 2, 3, 4, 5}, 3: {2, 3}, 4: {1, 2, 4, 5}, 5: {1, 2, 4, 5}}


def crowded(n, seed):
    rng = random.Random(seed)
    return [
        (i, 1.0, 1.0) if i % 3 == 0 else (i, rng.uniform(0, 30), rng.uniform(0, 30)) for i in range(n)
    ]


@pytest.mark.parametrize("salted", [False, True])
def test_equals_full_comparison(points, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(tiles, "BUSY", 1)
        monkeypatch.setattr(skew, "HOT_SHARE", 4)
    r, s = crowded(300, 1), crowded(150, 2) + [(7, 1.5, 1.0)] * 20
    want = sorted(p for p in brute.pairs(r, r, exclude_self=False) if p[2] <= 2.0)
    got = pairs(ts.radius_join(points(r), None, 2.0))
    assert got == want
    assert sorted((b, a, d) for a, b, d in got) == got
    want = sorted(p for p in brute.pairs(r, s, exclude_self=True) if p[2] <= 1.5)
    assert pairs(ts.radius_join(points(r), points(s), 1.5, exclude_self=True)) == want


@pytest.mark.parametrize("salted", [False, True])
def test_larger_tiles_give_the_same_pairs(points, monkeypatch, salted):
    monkeypatch.setattr(radii, "TILE", 8)
    monkeypatch.setattr(radii, "TILES", 2, raising=False)
    if salted:
        monkeypatch.setattr(tiles, "BUSY", 1)
        monkeypatch.setattr(skew, "HOT_SHARE", 4)
    sizes, join = [], radii.matches
    monkeypatch.setattr(radii, "matches", lambda packed, *a, **more: sizes.append(packed.size) or join(packed, *a, **more))
    odd = [(None, 1.0, 1.0), (9, -0.0, 0.0), (9, 0.0, -0.0), (9, None, 1.0), (9, float("inf"), 0.0)]
    r, s = points(crowded(450, 6) + odd), points(crowded(390, 7) + odd * 2)
    finite = [p for p in crowded(450, 6) + odd if p[1] is not None and abs(p[1]) < 1e9]
    others = [p for p in crowded(390, 7) + odd * 2 if p[1] is not None and abs(p[1]) < 1e9]

    for a, b, left, right in ((r, None, finite, finite), (r, s, finite, others)):
        for most in (9.0, 0.0):
            got = Counter((row.src, row.dst) for row in ts.radius_join(a, b, most).collect())
            near = [(p[0], q[0]) for p in left for q in right if math.sqrt((p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2) <= most]
            assert sizes[-1] > radii.TILE
            assert got == Counter(near)


def test_rows_sent_grow_with_the_input(points, monkeypatch):
    monkeypatch.setattr(radii, "TILES", 16, raising=False)
    met, join = [], radii.matches

    def counted(packed, probes, targets, *more, **named):
        met.append((packed.size, tiles.tile_pairs(packed, probes, targets).count()))
        return join(packed, probes, targets, *more, **named)

    monkeypatch.setattr(radii, "matches", counted)
    rng = random.Random(8)
    for n, most in ((4096, 0.5), (16384, 0.5), (4096, 0.001)):
        ts.radius_join(points([(i, rng.random(), rng.random()) for i in range(n)]), None, most)
    # A row is sent to each tile that its own meets: with four times the rows, to no more of them.
    (small, few), (large, many), (sparse, _) = met
    assert large == 4 * small and many <= 1.2 * few
    assert sparse == radii.TILE


def test_capped(points):
    r = crowded(100, 3)
    found = [p for p in brute.pairs(r, r, exclude_self=False) if p[2] <= 3.0]
    assert brute.rows(ts.radius_join_capped(points(r), None, 3.0, 5)) == brute.top_k(found, 5, "all")


@pytest.mark.parametrize("salted", [False, True])
def test_expanded_places_equal_the_join(points, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(skew, "HOT_SHARE", 4)
        monkeypatch.setattr("tessera.operators.radius.CROWD", 1)
    r, s = points(crowded(300, 4) + [(None, 1.0, 1.0), (8, float("nan"), 1.0)] * 2), points(crowded(150, 5))
    for a, b, itself in ((r, None, True), (r, None, False), (r, s, False), (r, s, True)):
        got = ts.expand_places(ts.radius_places(a, b, 1.5), a, b, itself)
        want = ts.radius_join(a, b, 1.5, itself)
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_expanded_query_has_every_pair_of_rows(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, rng.randrange(3), rng.choice([1.0, 499.0, 501.0, -20.0, None])) for i in range(60)] + [(60, None, 1.0)]
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    got = entry.queries()["radius_places_expanded"](spark, str(tmp_path))
    placed = [(i, float(x), float(y // 500)) for i, x, y in rows if x is not None and y is not None]
    assert got.columns == ["src", "dst", "dist"]
    assert pairs(got) == sorted(p for p in brute.pairs(placed, placed) if p[2] <= 1.0)


def test_pairs_of_crowded_places_are_dealt_by_their_number(points, monkeypatch):
    monkeypatch.setattr(radii, "PAIRS_PER_TASK", 1000, raising=False)
    r = points([(i, float(i % 2), 0.0) for i in range(400)])
    found = ts.expand_places(ts.radius_places(r, None, 1.0), r)
    sizes = [n.n for n in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 160_000 and len(sizes) > 32 and max(sizes) < 16_000


@pytest.mark.parametrize("salted", [False, True])
def test_members_have_the_links_of_the_join(points, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(skew, "HOT_SHARE", 4)
        monkeypatch.setattr("tessera.operators.radius.CROWD", 1)
    r = points(crowded(200, 4) + [(None, 1.0, 1.0), (3, 1.0, 1.0), (8, float("nan"), 1.0)] * 2)
    for s in (None, points(crowded(150, 5) + [(None, 1.0, 1.0)])):
        for itself in (False, True):
            places = ts.radius_places(r, s, 1.5)
            want = Counter(m.src for m in ts.expand_places(places, r, s, itself).collect())
            got = Counter()
            rows = ts.expand_places(places, r, s, itself, members=True).collect()
            for m in rows:
                got[m.src] += m.links
            assert +got == want
            if s is None:
                assert len(rows) == 204


def test_members_of_a_crowded_place_are_not_paired(points, spark):
    """10^10 pairs: they could not be written out."""
    copies = spark.range(100_000).selectExpr("id", "1.0D x", "if(id % 2 = 0, 0.0D, 1.0D) y")
    members = ts.expand_places(ts.radius_places(copies, None, 1.0), copies, exclude_self=True, members=True)
    assert members.groupBy("links").count().collect() == [(99_999, 100_000)]


def test_copies_of_a_place_are_one_place(points, spark):
    copies = spark.range(20_000).selectExpr("id", "1.0D x", "if(id % 2 = 0, 0.0D, -0.0D) y")
    got = ts.radius_places(copies.union(points([(-1, 1.5, 0.0)])), None, 0.4).collect()
    assert sorted(map(tuple, got)) == [(1.0, 0.0, 20_000, 1.0, 0.0, 20_000, 0.0), (1.5, 0.0, 1, 1.5, 0.0, 1, 0.0)]
    assert ts.radius_places(points([]), None, 1.0).count() == 0
    assert ts.expand_places(ts.radius_places(points([]), None, 1.0), points([])).count() == 0


def test_odd_radius_inputs(points):
    assert pairs(ts.radius_join(points([]), None, 1.0)) == []
    data = [(1, 0.0, 0.0), (2, float("nan"), 0.0), (3, None, 0.0), (4, 0.0, 0.0)]
    got = pairs(ts.radius_join(points(data), None, 0.0))
    assert got == [(1, 1, 0.0), (1, 4, 0.0), (4, 1, 0.0), (4, 4, 0.0)]
    with pytest.raises(ValueError):
        ts.radius_join(points(FIVE), None, -1.0)


def test_grid_cells(points):
    df = points([(1, 0.0, 0.0), (2, 1.0, 1.0), (3, 2.0, 2.0), (4, 0.0, 2.0)])
    free = {(r.id, r.cx, r.cy) for r in ts.grid_cells(df, 2, 2).collect()}
    assert free == {(1, 0, 0), (2, 1, 1), (3, 2, 2), (4, 0, 2)}
    held = {(r.id, r.cx, r.cy) for r in ts.grid_cells(df, 2, 2, clamp=True).collect()}
    assert held == {(1, 0, 0), (2, 1, 1), (3, 1, 1), (4, 0, 1)}
    flat = {(r.cx, r.cy, r.n) for r in ts.grid_histogram(points([(1, 5.0, 1.0), (2, 5.0, 1.0)])).collect()}
    assert flat == {(0, 0, 2)}


@pytest.mark.parametrize("run", [1 << 16, 4])
def test_upsample_keeps_the_density(points, monkeypatch, run):
    monkeypatch.setattr(growing, "RUN", run)
    df = points(crowded(60 if run == 4 else 400, 4))
    grown = ts.upsample(df, 3).cache()
    counts = {(r.cx, r.cy): r.n for r in ts.grid_histogram(df).collect()}
    after = {(r.cx, r.cy): r.n for r in ts.grid_histogram(grown, box=ts.bounding_box(df)).collect()}
    total = sum(counts.values()) * 3
    ids = [r.id for r in grown.select("id").orderBy("id").collect()]
    assert ids == list(range(1, total + 1))
    assert after == {cell: 3 * n for cell, n in counts.items()}
    again = ts.upsample(df.repartition(7), 3)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, grown.collect()))
    other = ts.upsample(df, 3, seed=1)
    assert sorted(map(tuple, other.collect())) != sorted(map(tuple, grown.collect()))


def test_dedup_last(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 3, "b"), (2, 1, "c"), (1, 3, "a")], "id int, at int, t string")
    got = {tuple(r) for r in ts.dedup_last(df, "id", ["at"]).collect()}
    assert got == {(1, 3, "b"), (2, 1, "c")}


def test_top_k(spark):
    df = spark.createDataFrame(
        [(1, 5, 1.0), (1, 4, 1.0), (1, 3, 2.0), (1, 2, float("nan")), (2, 1, 0.0)],
        "src int, dst int, dist double",
    )
    assert brute.rows(ts.top_k(df, 3)) == {(1, 4, 1.0, 1), (1, 3, 2.0, 2), (1, 2, "NaN", 3), (2, 1, 0.0, 1)}
    assert brute.rows(ts.top_k(df, 2, "all")) == {(1, 4, 1.0, 1), (1, 5, 1.0, 2), (2, 1, 0.0, 1)}
    nested = {r.src: [tuple(n) for n in r.neighbours] for r in ts.neighbour_lists(ts.top_k(df, 2)).collect()}
    assert nested == {1: [(1.0, 4), (2.0, 3)], 2: [(0.0, 1)]}


def test_box_can_be_given(points):
    box = ts.bounding_box(points([(1, 0.0, 0.0), (2, 10.0, 10.0)]))
    got = ts.grid_histogram(points([(1, 2.0, 7.0)]), 10, 10, box=box).collect()
    assert [(r.cx, r.cy, r.n) for r in got] == [(2, 7, 1)]


def test_odd_rows_leave_the_cells_of_others(points):
    nan, inf = float("nan"), float("inf")
    data = crowded(50, 6)
    odd = [(900, nan, 1.0), (901, 1.0, -inf), (902, None, 2.0)]
    plain = {(r.id, r.cx, r.cy) for r in ts.grid_cells(points(data)).collect()}
    mixed = {(r.id, r.cx, r.cy) for r in ts.grid_cells(points(data + odd)).collect()}
    assert mixed == plain | {(i, None, None) for i, *_ in odd}
    grown = ts.upsample(points(data + odd), 3)
    assert sorted(map(tuple, grown.collect())) == sorted(map(tuple, ts.upsample(points(data), 3).collect()))


def test_upsample_works_in_all_tasks(spark, points, monkeypatch):
    monkeypatch.setattr(growing, "TASK", 1 << 16)
    grown = ts.upsample(points([(i, float(i % 3), float(i % 2)) for i in range(100)]), 20_000)
    rows = [r.n for r in grown.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(rows) == 2_000_000 and len(rows) >= 8 and max(rows) < 500_000


def test_capped_at_a_crowded_place(points):
    data = [(i, 1.0, 1.0) for i in range(20_000)] + [(30_000, 1.0, 1.5)]
    found = ts.radius_join_capped(points(data), None, 1.0, 3).where("src IN (0, 1, 30000)")
    assert brute.rows(found) == {
        (0, 0, 0.0, 1), (0, 1, 0.0, 2), (0, 2, 0.0, 3), (1, 0, 0.0, 1), (1, 1, 0.0, 2), (1, 2, 0.0, 3),
        (30_000, 30_000, 0.0, 1), (30_000, 0, 0.5, 2), (30_000, 1, 0.5, 3),
    }

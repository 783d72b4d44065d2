"""Ring partitioning around the origin, and the approximate kNN join over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.cells import finite, ring_id, ring_key
from tessera.functions.metrics import euclidean
from tessera.operators.topk import check_ties, top_k
from tessera.plans.cut import written
from tessera.plans.nearest import knn_join
from tessera.plans.skew import salted_join

BOUNDARIES = ("fraction", "relative")

# Parts of a ring that count as near its lower and upper edge.
NEAR_LOWER = 0.3
NEAR_UPPER = 0.7


def _located(points: DataFrame) -> DataFrame:
    return points.where(F.col("x").isNotNull() & F.col("y").isNotNull())


def point_stats(points: DataFrame, k: int = 5, num_rings: int | None = None) -> DataFrame:
    """One row: point count, ring count, smallest and largest key, ring width.

    The ring count defaults to ``n / k``, so that a ring holds ``k`` points on
    average, and is at least 1. Counts and keys are those of the points whose key
    is a finite number.
    """
    key = ring_key(F.col("x"), F.col("y"))
    rings = F.floor(F.col("n") / F.lit(k)) if num_rings is None else F.lit(num_rings)
    return (
        _located(points)
        .agg(
            F.count_if(finite(key)).alias("n"),
            F.min(F.when(finite(key), key)).alias("min_key"),
            F.max(F.when(finite(key), key)).alias("max_key"),
        )
        .withColumn("rings", F.greatest(F.lit(1), rings).cast("long"))
        .withColumn("width", (F.col("max_key") - F.col("min_key")) / F.col("rings"))
        .select("n", "rings", "min_key", "max_key", "width")
    )


def ring_assign(
    points: DataFrame,
    k: int = 5,
    num_rings: int | None = None,
    boundary: str = "fraction",
) -> DataFrame:
    """Points with their ``key``, home ring ``home`` and position ``fr`` for replication.

    ``boundary="fraction"`` takes the fractional part of the offset inside the
    ring, in key units. ``"relative"`` takes the offset as a share of the width.
    ``fr`` is null where rings have no width. A point whose key is no finite
    number has no ring: ``home`` and ``fr`` are null.
    """
    if boundary not in BOUNDARIES:
        raise ValueError(f"boundary must be one of {BOUNDARIES}, not {boundary!r}")
    stats = point_stats(points, k, num_rings)
    one = stats.select(F.struct("min_key", "width").alias("stat")).scalar()
    low, width = one["min_key"], one["width"]
    offset = F.col("key") - low
    position = (
        F.try_mod(offset, width) if boundary == "fraction" else F.try_divide(offset, width)
    )
    return (
        _located(points)
        .withColumn("key", ring_key(F.col("x"), F.col("y")))
        .withColumn("home", ring_id(F.col("key"), low, width))
        .withColumn("_at", position)
        .withColumn("fr", F.when(finite(F.col("key")), F.col("_at") - F.floor("_at")))
        .drop("_at")
    )


def ring_replicas(
    points: DataFrame,
    k: int = 5,
    num_rings: int | None = None,
    boundary: str = "fraction",
    lower: float = NEAR_LOWER,
    upper: float = NEAR_UPPER,
) -> DataFrame:
    """One row per point and ring: its home and the neighbour ring it is near.

    A point without a ring has one row with a null ring.
    """
    fr: Column = F.nanvl(F.col("fr"), F.lit(None).cast("double"))
    rings = F.array(
        F.col("home"),
        F.when((fr < lower) & (F.col("home") > 0), F.col("home") - 1),
        F.when(fr > upper, F.col("home") + 1),
    )
    assigned = ring_assign(points, k, num_rings, boundary)
    return assigned.withColumn("ring", F.explode_outer(F.array_compact(rings))).drop("key", "home", "fr")


def _met() -> Column:
    """The members of ``ring`` other than ``s``, with their distances from it."""
    s = F.col("s")
    same = lambda t: (t["id"] == s["id"]) & (t["x"] == s["x"]) & (t["y"] == s["y"])
    return F.transform(
        F.filter("ring", lambda t: ~same(t)),
        lambda t: F.struct(euclidean(s["x"], s["y"], t["x"], t["y"]).alias("dist"), t["id"].alias("dst")),
    )


def _first(near: Column, k: int, ties: str) -> Column:
    """The ``k`` first of the neighbours ``near`` (dist, dst) of one source.

    Of equal distances only the smallest id stays, or with ``ties="all"`` each id once.
    """

    def again(got: Column, n: Column) -> Column:
        last = F.get(got, F.size(got) - 1)
        same = last["dist"] == n["dist"]
        return F.coalesce(same if ties == "distinct" else same & (last["dst"] == n["dst"]), F.lit(False))

    def pick(ordered: Column) -> Column:
        return F.aggregate(
            ordered,
            F.slice(ordered, 1, 0),
            lambda got, n: F.when((F.size(got) < k) & ~again(got, n), F.concat(got, F.array(n))).otherwise(got),
        )

    # Bound to a name, so that the sorted array is computed once.
    return F.get(F.transform(F.array(F.sort_array(near)), pick), F.lit(0))


# Rings with fewer rows than this need no salting.
HOT_RING = 1 << 14

# Rings of at most so many rows are met row by row; larger ones go through tiles.
SMALL_RING = 1024


def knn_ring(
    points: DataFrame,
    k: int = 5,
    num_rings: int | None = None,
    boundary: str = "fraction",
    ties: str = "distinct",
    keep_empty: bool = False,
    unique_ids: bool = False,
) -> DataFrame:
    """Approximate kNN self-join: neighbours are sought in shared rings only.

    The result equals the join of all pairs that share a ring, followed by the
    ``k`` nearest per source. Rings of at most ``SMALL_RING`` rows are joined as
    they are; larger rings are searched with bounds, so a ring that holds much of
    the data is not paired with itself. A source may get fewer than ``k`` rows, or
    none when alone in its rings; ``keep_empty`` then yields one row with nulls.
    Points without finite coordinates are at distance NaN from all others, points
    whose key is beyond the largest number share one ring.
    """
    check_ties(ties)
    copies = ring_replicas(points.select("id", "x", "y"), k, num_rings, boundary)
    copies = copies.select("id", "x", "y", F.coalesce("ring", F.lit(-1)).cast("long").alias("g"))
    if not unique_ids:
        copies = copies.distinct()
    astray = ~finite(F.col("x"), F.col("y"))
    sizes = copies.groupBy("g").agg(F.count("*").alias("n"), F.count_if(astray).alias("astray"))
    # A ring may hold much of the data, so its rows are dealt over tasks to meet its size.
    hot = HOT_RING < points.count()
    sized = salted_join(copies, sizes, ["g"], ["id"], HOT_RING) if hot else copies.join(sizes, "g")
    sized = written(sized, "rings")
    most = sized.agg(F.max("n").alias("n"), F.max("astray").alias("astray")).first()
    # At most SMALL_RING members each, so a ring fits a row.
    rings = sized.where((F.col("n") <= SMALL_RING) & ~astray).groupBy("g").agg(
        F.collect_list(F.struct("id", "x", "y")).alias("ring")
    )
    sources = rings.select(F.explode("ring").alias("s"), "ring")
    inside = sources.select(F.col("s.id").alias("src"), _first(_met(), k, ties).alias("near"))
    larger = (most["n"] or 0) > SMALL_RING or most["astray"]
    if unique_ids and not larger:
        # A point has three rings at most.
        lists = inside.groupBy("src").agg(F.flatten(F.collect_list("near")).alias("near"))
        found = lists.select("src", F.posexplode(_first(F.col("near"), k, ties)).alias("rk", "n"))
        found = found.select("src", "n.dst", "n.dist", (F.col("rk") + 1).alias("rk"))
    else:
        found = inside.select("src", F.inline("near")).select("src", "dst", "dist")
        if larger:
            # Rows without a place are within reach of all others, so then all take part.
            more = sized if most["astray"] else sized.where(F.col("n") > SMALL_RING)
            searched = knn_join(
                more.select("id", "x", "y", "g"), None, k, ties=ties, unique_ids=unique_ids, grouped=True
            )
            found = searched.select("src", "dst", "dist").unionByName(found)
        found = top_k(found.distinct() if ties == "all" else found, k, ties)
    if keep_empty:
        ids = points.select(F.col("id").alias("src")).distinct()
        found = ids.join(found, "src", "left")
    return found

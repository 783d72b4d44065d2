"""Exact k-nearest-neighbour join over packed tiles: bound, then refine.

1. Rows are compacted to distinct places, so copies at one place are searched
   once and never paired with each other.
2. Every place takes the k-th distinct distance among places next to it on the
   curve as an upper bound on its k-th neighbour.
3. Tiles within that bound are searched, and the k smallest distances are kept.
4. The results of a place are handed to all ids that share it.

The idea of bounding first and refining afterwards follows published kNN-join
work (Lu et al., VLDB 2012; Zhang et al., EDBT 2012).
"""

from __future__ import annotations

from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.cells import Box
from tessera.operators.topk import check_ties, top_k
from tessera.plans import window_bound
from tessera.plans.cut import written
from tessera.plans.skew import copy, deal, hot_keys, salted_join
from tessera.plans.tiles import VECTOR_TILE, Packed, Pivoted, Plane, matches, pack, plane_nearest, vector_matches

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(window_bound)

# A key with fewer source rows than this needs no salting, and an input with
# fewer rows is cheaper to compute twice than to write.
CROWD = 1 << 14


def _finite() -> Column:
    return F.expr("abs(x) < double('inf') and abs(y) < double('inf')")


def _compact(points: DataFrame, place: list[str], cap: int, unique_ids: bool) -> DataFrame:
    """One row per place with its smallest ids, at most ``cap + 1`` of them.

    The rank filter runs ahead of the shuffle as a group limit, so a place that
    holds a third of all rows sends ``cap + 1`` rows per task.
    """
    rows = points if unique_ids else points.distinct()
    first = Window.partitionBy(*place).orderBy("id")
    ranked = rows.withColumn("rk", F.row_number().over(first)).where(F.col("rk") <= cap + 1)
    return _nested(ranked, place, F.col("id"), "ids").drop("id")


def _nested(ranked: DataFrame, by: list[str], value: Column, name: str) -> DataFrame:
    """One row per ``by`` with ``value`` nested, from rows limited by their rank ``rk``.

    A window reuses the order of the ranking, where an aggregate would sort again.
    """
    values = F.collect_list(value).over(Window.partitionBy(*by))
    return (
        ranked.withColumn(name, F.sort_array(values)).where(F.col("rk") == 1).drop("rk")
    )


def _places(
    r: DataFrame, s: DataFrame | None, place: list[str], cap: int, unique_ids: bool
) -> DataFrame:
    """Distinct places with the ids of sources and of targets there."""
    at_r = _compact(r, place, cap, unique_ids).withColumnRenamed("ids", "r_ids")
    if s is None:
        # The same ids on both sides are written once.
        return at_r
    at_s = _compact(s, place, cap, unique_ids).withColumnRenamed("ids", "s_ids")
    return at_r.join(at_s, place, "full")


def _bounds(packed: Packed, sources: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    """Add ``bound``: the k-th distinct distance to other places in the own tile.

    Infinite where the tile has fewer; such a source searches all targets.
    """
    shape = packed.shape
    q = sources.select(*[F.col(c) if c == "tile" else F.col(c).alias(f"q_{c}") for c in sources.columns])
    t = targets.select("tile", *[F.col(c).alias(f"t_{c}") for c in ("g", *shape.columns)])
    if packed.n_rows <= CROWD:
        met, by = q.join(t, "tile"), ["tile"]
    else:
        hot = hot_keys(q, ["tile"], CROWD)
        met = deal(q, hot, ["tile"], ["q_rank"]).join(copy(t, hot, ["tile"]), ["tile", "_salt"])
        by = ["tile", "_salt"]
    dist = shape.distance(lambda c: F.col(f"q_{c}"), lambda c: F.col(f"t_{c}"))
    counts = (F.col("q_g") == F.col("t_g")) & _elsewhere(shape)
    # A tile bounds the number of distances per source.
    reached = F.sort_array(F.collect_set(F.when(counts, dist)))
    rest = [c for c in sources.columns if c not in ("tile", "rank")]
    return (
        met.groupBy(*by, F.col("q_rank").alias("rank"))
        .agg(F.get(reached, F.lit(k - 1)).alias("kth"), *[F.any_value(f"q_{c}").alias(c) for c in rest])
        .withColumn("bound", F.coalesce("kth", F.lit(float("inf"))))
        .select("rank", "tile", *rest, "bound")
    )


def _elsewhere(shape: Plane | Pivoted) -> Column:
    """Source and target are at different places."""
    return ~reduce(
        lambda a, b: a & b, [F.col(f"q_{c}") == F.col(f"t_{c}") for c in shape.columns]
    )


def _neighbours(k: int, ties: str, exclude_self: bool) -> Column:
    """Merge the ids at the own place (distance 0) with the ``others`` list."""
    here = F.coalesce("s_ids", F.slice("r_ids", 1, 0))
    if exclude_self:
        here = F.array_remove(here, F.col("src"))
    zero = lambda i: F.struct(F.lit(0.0).alias("dist"), i.alias("dst"))
    others = F.col("others")
    if ties == "all":
        own = F.transform(F.slice(here, 1, k), zero)
        return F.slice(F.sort_array(F.concat(own, others)), 1, k)
    first = F.get(here, F.lit(0))
    # Two places so close that their distance rounds to 0 share one entry.
    touching = F.get(others, F.lit(0))["dist"] == 0.0
    nearest = F.least(first, F.get(others, F.lit(0))["dst"])
    merged = (
        F.when(first.isNull(), others)
        .when(touching, F.concat(F.array(zero(nearest)), F.slice(others, 2, k)))
        .otherwise(F.concat(F.array(zero(first)), others))
    )
    return F.slice(merged, 1, k)


def _search(
    r: DataFrame,
    s: DataFrame | None,
    n_rows: int,
    box: Box,
    k: int,
    ties: str,
    exclude_self: bool,
    unique_ids: bool,
    shape: Plane | Pivoted,
    radius: float | None = None,
    work: bool = False,
) -> DataFrame:
    place = ["g", *shape.columns]
    cap = max(k + 1, 8)
    axes = ["v"] if "v" in shape.columns else ["x", "y"]

    def enrich(rows: DataFrame) -> DataFrame:
        schema = T.StructType([*rows.schema, T.StructField("bound", T.DoubleType())])
        return rows.mapInArrow(window_bound.add_bound(k, axes), schema)

    places = _places(r, s, place, cap, unique_ids)
    if n_rows > CROWD:
        # Range partitioning reads its input twice, to sample and to send.
        places = written(places, "places")
    vectors = isinstance(shape, Pivoted)
    size = window_bound.span_for(k) // 2
    packed = pack(
        places,
        n_rows,
        box,
        max(size, VECTOR_TILE) if vectors and s is None else size,
        shape,
        target=None if s is None else F.col("s_ids").isNotNull(),
        width=F.coalesce(F.size("r_ids"), F.lit(0)),
        enrich=enrich if s is None else None,
    )
    if s is None:
        bounds = targets = packed.rows.withColumn("s_ids", F.col("r_ids"))
    else:
        sources = packed.rows.where(F.col("r_ids").isNotNull())
        targets = packed.rows.where(F.col("s_ids").isNotNull())
        bounds = written(_bounds(packed, sources, targets, k), "bounds")
    if radius is not None:
        bounds = bounds.withColumn("bound", F.least("bound", F.lit(float(radius))))

    def joined(rows: DataFrame, lists: DataFrame) -> DataFrame:
        none = F.array().cast(lists.schema["others"].dataType)
        return rows.join(lists, "rank", "left").withColumn("others", F.coalesce("others", none))

    def nested(pairs: DataFrame) -> DataFrame:
        ranked = top_k(pairs, k, ties, by="q_rank")
        return _nested(ranked, ["q_rank"], F.struct("dist", "dst"), "others").withColumnRenamed("q_rank", "rank")

    if s is None and ties == "distinct" and not vectors:
        solved, parts = plane_nearest(packed, bounds, k)
        if parts is not None:
            # Places of wide blocks have a list per block that they met; those without any stay.
            parts = written(parts, "parts")
            met = parts.select(F.col("rank").alias("q_rank"), F.explode("others").alias("n"))
            lists = nested(met.select("q_rank", "n.dist", "n.dst")).select("rank", "others")
            solved = solved.unionByName(joined(parts.drop("others").dropDuplicates(["rank"]), lists))
        solved = solved.withColumn("s_ids", F.col("r_ids"))
    else:
        if vectors:
            if work:
                return vector_matches(packed, bounds, targets, k, ties, count=True)
            found = vector_matches(packed, bounds, targets, k, ties)
        else:
            found = matches(packed, bounds, targets, ["rank"], ["s_ids"], _elsewhere(shape))
        if ties == "distinct":
            pairs = found.select("q_rank", "dist", F.get("t_s_ids", F.lit(0)).alias("dst"))
        else:
            first_ids = F.explode(F.slice("t_s_ids", 1, k)).alias("dst")
            pairs = found.select("q_rank", "dist", first_ids)
            if not unique_ids:
                pairs = pairs.distinct()
        solved = joined(bounds, nested(pairs).select("rank", "others"))

    few = solved
    if packed.widest > cap:
        few = solved.where(F.size("r_ids") <= cap)
    handed = few.select(F.explode("r_ids").alias("src"), "r_ids", "s_ids", "others")
    if packed.widest > cap:
        # Places with more ids than were kept: go back to the rows there.
        many = solved.where(F.size("r_ids") > cap).select(*place, "r_ids", "s_ids", "others")
        rows = r if unique_ids else r.distinct()
        joined = salted_join(rows.withColumnRenamed("id", "src"), many, place, ["src"], CROWD)
        handed = handed.unionByName(joined.select("src", "r_ids", "s_ids", "others"))
    return handed.select(
        "src", F.posexplode(_neighbours(k, ties, exclude_self)).alias("rk", "n")
    ).select("src", "n.dst", "n.dist", (F.col("rk") + 1).alias("rk"))


def knn_join(
    r: DataFrame,
    s: DataFrame | None,
    k: int,
    *,
    ties: str = "distinct",
    exclude_self: bool = True,
    unique_ids: bool = False,
    grouped: bool = False,
    shape: Plane | Pivoted = Plane(),
    radius: float | None = None,
    work: bool = False,
) -> DataFrame:
    """The ``k`` nearest rows of ``s`` for every row of ``r``, within ``g``.

    Inputs have ``id``, ``g``, ``x``, ``y`` (and ``v`` for vectors); ``s=None`` means
    a self-join. Result: ``src``, ``dst``, ``dist``, ``rk``. A self pair has the same
    id and the same place.

    ``unique_ids`` promises that an id occurs once per group on each side, which
    saves the shuffles that merge repeated ids. ``grouped`` says that an id may
    occur in several groups. Rows without coordinates take no part. A NaN or
    infinite coordinate puts a row at distance NaN from everything, which sorts
    last. ``radius`` limits the distance. ``work``, for vectors, gives the numbers of
    distances computed instead of neighbours.
    """
    check_ties(ties)
    if k < 1:
        raise ValueError("k must be at least 1")
    columns = ["id", "g", *shape.columns]

    def placed(df: DataFrame) -> DataFrame:
        # Adding 0.0 turns -0.0 into 0.0, so equal places have equal bits.
        return df.select(
            "id",
            "g",
            *[(F.col(c) + F.lit(0.0)).alias(c) for c in ("x", "y")],
            *[c for c in shape.columns if c not in ("x", "y")],
        ).where(F.col("x").isNotNull() & F.col("y").isNotNull())

    r = placed(r)
    s = None if s is None else placed(s)
    every = r if s is None else r.unionByName(s)
    stat = every.agg(
        *[
            agg(F.when(_finite(), F.col(c))).alias(f"{c}_{name}")
            for c in ("x", "y")
            for agg, name in ((F.min, "min"), (F.max, "max"))
        ],
        F.count_if(~_finite()).alias("astray"),
        F.count("*").alias("n"),
    ).first()
    box = Box(*[stat[f"{c}_{end}"] or 0.0 for c in ("x", "y") for end in ("min", "max")])
    if stat["astray"]:
        near_r = r.where(_finite())
        near_s = None if s is None else s.where(_finite())
    else:
        near_r, near_s = r, s
    result = _search(near_r, near_s, stat["n"], box, k, ties, exclude_self, unique_ids, shape, radius, work)
    if work:
        return result.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in result.columns])
    if stat["astray"] and radius is None:
        astray = _astray(r, r if s is None else s, k, exclude_self)
        result = result.select("src", "dst", "dist").unionByName(astray)
        grouped = True
    if grouped or not unique_ids:
        pairs = result.select("src", "dst", "dist")
        return top_k(pairs.distinct() if ties == "all" else pairs, k, ties)
    return result.select("src", "dst", "dist", "rk")


def _astray(r: DataFrame, s: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Pairs at distance NaN that can still be among the ``k`` nearest.

    Only the smallest ids can, so ``k + 1`` of them are enough on each side. A
    row whose coordinates have no place makes every ring the same ring, so
    groups do not matter here.
    """

    def smallest(df: DataFrame) -> list:
        return [row["id"] for row in df.select("id").distinct().orderBy("id").limit(k + 1).collect()]

    def paired(sources: DataFrame, ids: list) -> DataFrame:
        dst = F.explode(F.array(*[F.lit(i) for i in ids])) if ids else F.explode(F.array(F.col("id")))
        out = sources.select(F.col("id").alias("src"), dst.alias("dst")).withColumn(
            "dist", F.lit(float("nan"))
        )
        return out if ids else out.where(F.lit(False))

    out = paired(r.where(_finite()), smallest(s.where(~_finite()))).unionByName(
        paired(r.where(~_finite()), smallest(s))
    )
    return out.where(F.col("src") != F.col("dst")) if exclude_self else out

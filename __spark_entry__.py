"""Registered queries, their DuckDB equivalents, and the flagship query."""

from __future__ import annotations

import atexit
import os
import re
import sys
import tempfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import tessera as ts  # noqa: E402
from tessera.plans import cut  # noqa: E402

try:
    import corpus_pipeline
    from tessera.llm import queries as llm
except ModuleNotFoundError as error:
    # Only the absence of the whole subpackage is expected.
    if error.name not in ("corpus_pipeline", "tessera.llm"):
        raise
    llm = None

K = 5
VEC_DIMS = 64


def _with_folder(query: Callable[[SparkSession, str], DataFrame]):
    """Run ``query`` with a folder for intermediate tables.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Only a session in
    one process that has none gets one here, as this module is run without settings too.
    """

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        try:
            cut.folder(spark)
        except RuntimeError:
            if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
                raise
            own = tempfile.TemporaryDirectory(prefix="tessera-")
            atexit.register(own.cleanup)
            spark.sparkContext.setCheckpointDir(own.name)
        return query(spark, sf_dir)

    return run


# --- point views over the tables -------------------------------------------


def _points(
    table: str, id_column: str, x: Callable[[], Column], y: Callable[[], Column]
) -> Callable[[SparkSession, str], DataFrame]:
    def load(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(
            F.col(id_column).alias("id"),
            x().cast("double").alias("x"),
            y().cast("double").alias("y"),
        )

    return load


VIEWS = {
    "part": _points("part", "p_partkey", lambda: F.col("p_size"), lambda: F.col("p_retailprice")),
    "customer": _points(
        "customer", "c_custkey", lambda: F.col("c_nationkey"), lambda: F.col("c_acctbal")
    ),
    "supplier": _points(
        "supplier", "s_suppkey", lambda: F.col("s_nationkey"), lambda: F.col("s_acctbal")
    ),
    "embeddings": _points(
        "embeddings",
        "vec_id",
        lambda: F.get("embedding", F.lit(0)),
        lambda: F.get("embedding", F.lit(1)),
    ),
    "orders": _points(
        "orders",
        "o_orderkey",
        lambda: F.col("o_totalprice"),
        lambda: F.datediff("o_orderdate", F.lit("1970-01-01")),
    ),
    "lineitem": _points(
        "lineitem", "l_orderkey", lambda: F.col("l_quantity"), lambda: F.col("l_extendedprice")
    ),
    # Crowded places: orders by year and day of the year, customers by nation and balance.
    "calendar": _points(
        "orders", "o_orderkey", lambda: F.year("o_orderdate"), lambda: F.dayofyear("o_orderdate")
    ),
    "segments": _points(
        "customer", "c_custkey", lambda: F.col("c_nationkey"), lambda: F.floor(F.col("c_acctbal") / 500)
    ),
    # Few ids with many places each.
    "nations": _points(
        "customer", "c_nationkey", lambda: F.col("c_acctbal"), lambda: F.col("c_custkey")
    ),
}

# The same views for DuckDB.
VIEW_SQL = {
    "part": "SELECT p_partkey id, p_size::DOUBLE x, p_retailprice::DOUBLE y FROM part",
    "customer": "SELECT c_custkey id, c_nationkey::DOUBLE x, c_acctbal::DOUBLE y FROM customer",
    "supplier": "SELECT s_suppkey id, s_nationkey::DOUBLE x, s_acctbal::DOUBLE y FROM supplier",
    "embeddings": "SELECT vec_id id, embedding[1]::DOUBLE x, embedding[2]::DOUBLE y FROM embeddings",
    "orders": "SELECT o_orderkey id, o_totalprice::DOUBLE x, "
    "date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::DOUBLE y FROM orders",
    "calendar": "SELECT o_orderkey id, year(o_orderdate)::DOUBLE x, dayofyear(o_orderdate)::DOUBLE y FROM orders",
    "segments": "SELECT c_custkey id, c_nationkey::DOUBLE x, floor(c_acctbal / 500)::DOUBLE y FROM customer",
    "lineitem": "SELECT l_orderkey id, l_quantity::DOUBLE x, l_extendedprice::DOUBLE y FROM lineitem",
    "nations": "SELECT c_nationkey id, c_acctbal::DOUBLE x, c_custkey::DOUBLE y FROM customer",
}


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v")
    )


# --- query builders ----------------------------------------------------------


def _on(view: str, query: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: query(VIEWS[view](spark, sf_dir))


def _knn_rs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.knn_exact(
        VIEWS["supplier"](spark, sf_dir),
        VIEWS["customer"](spark, sf_dir),
        K,
        exclude_self=False,
        unique_ids=True,
    )


def _knn_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.knn_vec(_vectors(spark, sf_dir), None, K, VEC_DIMS, unique_ids=True)


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_partkey").alias("src"),
        F.col("l_orderkey").alias("dst"),
        F.col("l_extendedprice").alias("dist"),
    )


DEDUP_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
DEDUP_COLUMNS = ["l_orderkey", *DEDUP_ORDER, "l_discount", "l_tax"]


def _dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*DEDUP_COLUMNS)
    return ts.dedup_last(lines, "l_orderkey", DEDUP_ORDER)


def _index_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two searches on one index, the second after it is opened again."""
    customers = VIEWS["customer"](spark, sf_dir)
    index = ts.build_index(customers)
    near = ts.radius_search(index, VIEWS["supplier"](spark, sf_dir), 20.0)
    own = ts.radius_search(ts.open_index(spark, index.path), customers, 2.0, exclude_self=True)
    return near.withColumn("search", F.lit("supplier")).unionByName(own.withColumn("search", F.lit("customer")))


def _radius_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources deduplicated by id, targets as they are."""
    points = VIEWS["nations"](spark, sf_dir)
    return ts.radius_join(ts.dedup_last(points, "id", ["x", "y"]), points, 100.0)


def _knn_beyond(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources beside the region of all targets."""
    sources = VIEWS["customer"](spark, sf_dir).withColumn("x", F.col("x") + 1000)
    return ts.knn_exact(sources, VIEWS["part"](spark, sf_dir), K, exclude_self=False, unique_ids=True)


def _knn_vec_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few values per component, so that very many distances are equal."""
    steps = F.transform("v", lambda c: F.round(c * 4) * 0.3)
    return ts.knn_vec(_vectors(spark, sf_dir).withColumn("v", steps), None, K, 16, unique_ids=True)


def _odd(points: DataFrame) -> DataFrame:
    """Some coordinates turned into NaN, infinity and null."""
    kind = F.pmod("id", F.lit(50))
    x = F.when(kind == 0, float("nan")).when(kind == 1, float("inf")).when(kind != 2, F.col("x"))
    return points.withColumn("x", x)


def _read_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the points as text lines, then read those."""
    path = cut.place(spark, "lines")
    ts.write_points(VIEWS["part"](spark, sf_dir), path)
    return ts.read_points(spark, path).select("id", "x", "y")


def _dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point lines with repeated ids, the last line per id kept."""
    lines = ts.point_lines(VIEWS["lineitem"](spark, sf_dir))
    points = ts.parse_points(lines).select("id", "x", "y")
    return ts.dedup_last(points, "id", ["x", "y"])


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ts.knn_exact(VIEWS["embeddings"](spark, sf_dir), None, K, unique_ids=True)
    nested = ts.neighbour_lists(found)
    shown = F.transform(
        "neighbours",
        lambda n: F.concat(
            n["dst"].cast("string"), F.lit(":"), F.round(n["dist"] * 1e6).cast("bigint").cast("string")
        ),
    )
    return nested.select("src", F.size("neighbours").cast("bigint").alias("n"), F.concat_ws(",", shown).alias("neighbours"))


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ts.knn_exact(VIEWS["embeddings"](spark, sf_dir), None, K, unique_ids=True)
    return ts.neighbour_report(found, F.round(F.col("dist") * 1e6).cast("bigint"))


def _upsample_counts(points: DataFrame) -> DataFrame:
    """Generated points counted on the grid of the original points."""
    grown = ts.upsample(points, factor=5)
    return ts.grid_histogram(grown, box=ts.bounding_box(points))


def _upsample_ids(points: DataFrame) -> DataFrame:
    return ts.upsample(points, factor=5).agg(
        F.count("*").alias("n"),
        F.count_distinct("id").alias("ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator and view; each takes (spark, sf_dir)."""
    unique = {"unique_ids": True}
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "point_stats": _on("part", lambda p: ts.point_stats(p, K)),
        "point_stats_lineitem": _on("lineitem", lambda p: ts.point_stats(p, K)),
        "bounding_box": _on("embeddings", ts.bounding_box),
        "ring_assign": _on("customer", lambda p: ts.ring_assign(p, K).select("id", "key", "home", "fr")),
        "ring_assign_relative": _on(
            "customer",
            lambda p: ts.ring_assign(p, K, boundary="relative").select("id", "key", "home", "fr"),
        ),
        "ring_replicas": _on("customer", lambda p: ts.ring_replicas(p, K).select("id", "ring")),
        "ring_replicas_relative": _on(
            "orders", lambda p: ts.ring_replicas(p, K, boundary="relative").select("id", "ring")
        ),
        "knn_brute": _on("part", lambda p: ts.knn_brute(p, None, K, **unique)),
        "knn_brute_keep_self": _on(
            "customer", lambda p: ts.knn_brute(p, None, K, exclude_self=False, **unique)
        ),
        "knn_lat_only": _on("part", lambda p: ts.knn_lat_only(p, K, **unique)),
        "knn_rs": _knn_rs,
        "knn_vec": _knn_vec,
        "knn_exact_part": _on("part", lambda p: ts.knn_exact(p, None, K, **unique)),
        "knn_exact_customer": _on("customer", lambda p: ts.knn_exact(p, None, K, **unique)),
        "knn_exact_embeddings": _on("embeddings", lambda p: ts.knn_exact(p, None, K, **unique)),
        "knn_exact_all_ties": _on("part", lambda p: ts.knn_exact(p, None, K, ties="all", **unique)),
        "knn_exact_orders": _on("orders", lambda p: ts.knn_exact(p, None, K, **unique)),
        "knn_exact_orders_all_ties": _on(
            "orders", lambda p: ts.knn_exact(p, None, K, ties="all", **unique)
        ),
        "knn_exact_lineitem": _on("lineitem", lambda p: ts.knn_exact(p, None, K)),
        "knn_exact_repeated_ids": _on("nations", lambda p: ts.knn_exact(p, None, K)),
        "knn_ring_repeated_ids": _on("nations", lambda p: ts.knn_ring(p, K)),
        "knn_ring_wide": _on("part", lambda p: ts.knn_ring(p, K, num_rings=8, **unique)),
        "knn_ring_all_ties": _on("part", lambda p: ts.knn_ring(p, K, ties="all", **unique)),
        "knn_ring_keep_empty": _on("customer", lambda p: ts.knn_ring(p, K, keep_empty=True, **unique)),
        "knn_ring_orders": _on("orders", lambda p: ts.knn_ring(p, K, **unique)),
        "top_k_distinct": lambda spark, sf_dir: ts.top_k(_prices(spark, sf_dir), K),
        "top_k_all": lambda spark, sf_dir: ts.top_k(_prices(spark, sf_dir), K, ties="all"),
        "neighbour_lists": _lists,
        "neighbour_report": _report,
        "radius_join": _on("embeddings", lambda p: ts.radius_join(p, None, 0.05)),
        "radius_join_part": _on("part", lambda p: ts.radius_join(p, None, 1.0)),
        "radius_join_exclude_self": _on(
            "customer", lambda p: ts.radius_join(p, None, 2.0, exclude_self=True)
        ),
        "radius_join_dedup_sources": _radius_sources,
        "index_radius": _index_radius,
        "radius_places": _on("calendar", lambda p: ts.radius_places(p, None, 2.0)),
        "radius_places_expanded": _on(
            "segments", lambda p: ts.expand_places(ts.radius_places(p, None, 1.0), p, exclude_self=True)
        ),
        "radius_join_capped": _on("embeddings", lambda p: ts.radius_join_capped(p, None, 0.05, 5)),
        "grid_histogram_odd": _on("embeddings", lambda p: ts.grid_histogram(_odd(p))),
        "ring_assign_odd": _on("customer", lambda p: ts.ring_assign(_odd(p), K).select("id", "home")),
        "point_stats_odd": _on("customer", lambda p: ts.point_stats(_odd(p), K)),
        "knn_beyond": _knn_beyond,
        "knn_vec_ties": _knn_vec_ties,
        "grid_histogram": _on("part", ts.grid_histogram),
        "grid_histogram_embeddings": _on("embeddings", ts.grid_histogram),
        "grid_histogram_clamped": _on("lineitem", lambda p: ts.grid_histogram(p, clamp=True)),
        "dedup_last": _dedup_last,
        "dedup_lines": _dedup_lines,
        "read_points": _read_points,
        "upsample_counts": _on("embeddings", _upsample_counts),
        "upsample_ids": _on("embeddings", _upsample_ids),
    }
    for view in ("part", "customer", "embeddings"):
        found[f"knn_ring_{view}"] = _on(view, lambda p: ts.knn_ring(p, K, **unique))
        found[f"knn_ring_relative_{view}"] = _on(
            view, lambda p: ts.knn_ring(p, K, boundary="relative", **unique)
        )
    if llm is not None:
        found |= llm.queries()
        found["pipeline"] = corpus_pipeline.run
    return {name: _with_folder(query) for name, query in found.items()}


# --- the same in SQL -----------------------------------------------------------

DIST = "sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y))"
DIST_X = "sqrt((a.x-b.x)*(a.x-b.x))"

DISTINCT_K = f"""g AS (SELECT src, dist, min(dst) dst FROM c GROUP BY src, dist),
k AS (SELECT src, dst, dist, row_number() OVER (PARTITION BY src ORDER BY dist)::INT rk FROM g)
SELECT src, dst, dist, rk FROM k WHERE rk <= {K}"""

ALL_K = f"""k AS (SELECT src, dst, dist,
  row_number() OVER (PARTITION BY src ORDER BY dist, dst)::INT rk FROM c)
SELECT src, dst, dist, rk FROM k WHERE rk <= {K}"""


def _brute_sql(r: str, s: str, on: str = "a.id <> b.id", dist: str = DIST, top: str = DISTINCT_K) -> str:
    return f"""WITH r AS ({VIEW_SQL[r]}), s AS ({VIEW_SQL[s]}),
c AS (SELECT a.id src, b.id dst, {dist} dist FROM r a JOIN s b ON {on}),
{top}"""


NOT_SELF = "NOT (a.id = b.id AND a.x = b.x AND a.y = b.y)"


def _passes_sql(view: str) -> str:
    """The k smallest distinct distances, one pass over all pairs per rank.

    Keeps no pairs, so it works where grouping all pairs by distance does not fit.
    """
    near = f"min(struct_pack(dist := {DIST}, dst := b.id))"
    passes = [f"n1 AS (SELECT a.id src, {near} n FROM p a JOIN p b ON {NOT_SELF} GROUP BY a.id)"]
    for rk in range(2, K + 1):
        passes.append(
            f"n{rk} AS (SELECT a.id src, {near} n FROM p a JOIN n{rk - 1} m ON a.id = m.src"
            f" JOIN p b ON {NOT_SELF} AND {DIST} > m.n.dist GROUP BY a.id)"
        )
    rows = " UNION ALL ".join(
        f"SELECT src, n.dst dst, n.dist dist, {rk}::INT rk FROM n{rk}" for rk in range(1, K + 1)
    )
    return f"WITH p AS ({VIEW_SQL[view]}),\n" + ",\n".join(passes) + f"\n{rows}"


def _ring_ctes(view: str, boundary: str = "fraction", rings: str = f"floor(count(*)/{K})") -> str:
    offset = {"fraction": "m - floor(m)", "relative": "d/width - floor(d/width)"}[boundary]
    return f"""WITH p AS (SELECT id, x, y, x*x+y*y "key" FROM ({VIEW_SQL[view]})),
b AS (SELECT min("key") mn, max("key") mx, greatest(1, {rings}) rings FROM p),
s AS (SELECT mn, (mx-mn)/rings width FROM b),
h AS (SELECT id, x, y, "key", "key"-mn d, width, floor(("key"-mn)/width)::BIGINT home,
      ("key"-mn) % width m FROM p CROSS JOIN s),
f AS (SELECT id, x, y, "key", home, {offset} fr FROM h),
a AS (SELECT id, x, y, home ring FROM f
      UNION ALL SELECT id, x, y, home-1 FROM f WHERE fr < 0.3 AND home > 0
      UNION ALL SELECT id, x, y, home+1 FROM f WHERE fr > 0.7)"""


def _ring_sql(view: str, boundary: str = "fraction", top: str = DISTINCT_K, **more) -> str:
    return f"""{_ring_ctes(view, boundary, **more)},
c AS (SELECT DISTINCT a.id src, b.id dst, {DIST} dist FROM a JOIN a b ON a.ring = b.ring AND {NOT_SELF}),
{top}"""


def _radius_sql(view: str, radius: float, on: str = "TRUE") -> str:
    return f"""WITH p AS ({VIEW_SQL[view]})
SELECT a.id src, b.id dst, {DIST} dist FROM p a JOIN p b ON {DIST} <= {radius} AND {on}"""


def _grid_ctes(view: str) -> str:
    return f"""WITH p AS ({VIEW_SQL[view]}),
b AS (SELECT min(x) x0, max(x) x1, min(y) y0, max(y) y1 FROM p),
c AS (SELECT floor((x-x0)/((x1-x0)/100))::BIGINT cx, floor((y-y0)/((y1-y0)/100))::BIGINT cy
      FROM p CROSS JOIN b)"""


def _near_sql(view: str) -> str:
    """Exact neighbours without all pairs, for places with many others at the same x.

    The place ``K`` steps up or down at the same x bounds the ``K``-th distance; a
    range join on y then finds all places that near.
    """
    return f"""WITH p AS (SELECT DISTINCT id, x, y FROM ({VIEW_SQL[view]})),
u AS (SELECT DISTINCT x, y FROM p),
w AS (SELECT x, y, 1.000001 * least(coalesce(lead(y, {K}) OVER o - y, 1e300), coalesce(y - lag(y, {K}) OVER o, 1e300)) reach
  FROM u WINDOW o AS (PARTITION BY x ORDER BY y)),
a AS (SELECT id, x, y, y - reach low, y + reach high, reach FROM p JOIN w USING (x, y)),
c AS (SELECT a.id src, b.id dst, {DIST} dist FROM a JOIN p b ON b.y >= a.low AND b.y <= a.high
  WHERE {DIST} <= a.reach AND {NOT_SELF}),
{DISTINCT_K}"""


ODD_X = "CASE id % 50 WHEN 0 THEN 'nan'::DOUBLE WHEN 1 THEN 'inf'::DOUBLE WHEN 2 THEN NULL ELSE x END"


def oracle_sql() -> dict[str, str]:
    """SQL that gives the same rows; absent where it is too slow on whole tables."""
    stats = """WITH p AS (SELECT x*x+y*y "key" FROM ({view})),
b AS (SELECT count(*) n, greatest(1, floor(count(*)/{k}))::BIGINT rings, min("key") min_key, max("key") max_key FROM p)
SELECT n, rings, min_key, max_key, (max_key-min_key)/rings width FROM b"""
    nested = _brute_sql("embeddings", "embeddings").replace(
        "SELECT src, dst, dist, rk FROM k WHERE rk", "SELECT * FROM k WHERE rk"
    )
    head, tail = nested.rsplit("SELECT * FROM k", 1)
    nested = f"{head.rstrip()}, t AS (SELECT * FROM k{tail})"
    prices = "WITH c AS (SELECT l_partkey src, l_orderkey dst, l_extendedprice dist FROM lineitem),\n"
    sql = {
        "point_stats": stats.format(view=VIEW_SQL["part"], k=K),
        "point_stats_lineitem": stats.format(view=VIEW_SQL["lineitem"], k=K),
        "bounding_box": f"SELECT min(x) min_x, max(x) max_x, min(y) min_y, max(y) max_y FROM ({VIEW_SQL['embeddings']})",
        "ring_assign": _ring_ctes("customer") + '\nSELECT id, "key", home, fr FROM f',
        "ring_assign_relative": _ring_ctes("customer", "relative") + '\nSELECT id, "key", home, fr FROM f',
        "ring_replicas": _ring_ctes("customer") + "\nSELECT id, ring FROM a",
        "ring_replicas_relative": _ring_ctes("orders", "relative") + "\nSELECT id, ring FROM a",
        "knn_brute": _brute_sql("part", "part"),
        "knn_brute_keep_self": _brute_sql("customer", "customer", "TRUE"),
        "knn_lat_only": _brute_sql("part", "part", "TRUE", DIST_X),
        "knn_rs": _brute_sql("supplier", "customer", "TRUE"),
        "knn_vec": f"""WITH p AS (SELECT vec_id id, embedding::DOUBLE[] v FROM embeddings),
c AS (SELECT a.id src, b.id dst, sqrt(list_sum(list_transform(range(1, {VEC_DIMS + 1}),
  lambda i: (a.v[i]-b.v[i])*(a.v[i]-b.v[i])))) dist FROM p a JOIN p b ON a.id <> b.id),
{DISTINCT_K}""",
        "knn_exact_part": _brute_sql("part", "part"),
        "knn_exact_customer": _brute_sql("customer", "customer"),
        "knn_exact_embeddings": _brute_sql("embeddings", "embeddings"),
        "knn_exact_all_ties": _brute_sql("part", "part", top=ALL_K),
        "knn_exact_orders": _passes_sql("orders"),
        "knn_exact_orders_all_ties": f"""WITH p AS ({VIEW_SQL["orders"]}),
t AS (SELECT a.id src, min(struct_pack(dist := {DIST}, dst := b.id), {K}) n FROM p a JOIN p b ON a.id <> b.id GROUP BY a.id),
u AS (SELECT src, unnest(n) e, generate_subscripts(n, 1) rk FROM t)
SELECT src, e.dst dst, e.dist dist, rk::INT rk FROM u""",
        "knn_exact_repeated_ids": _brute_sql("nations", "nations", NOT_SELF),
        "knn_ring_repeated_ids": _ring_sql("nations"),
        "knn_ring_wide": _ring_sql("part", rings="8"),
        "knn_ring_all_ties": _ring_sql("part", top=ALL_K),
        "knn_ring_keep_empty": _ring_sql("customer").replace(
            "SELECT src, dst, dist, rk FROM k",
            "SELECT p.id src, dst, dist, rk FROM p LEFT JOIN (SELECT * FROM k",
        )
        + ") n ON p.id = n.src",
        "knn_ring_orders": _ring_sql("orders"),
        "top_k_distinct": prices + DISTINCT_K,
        "top_k_all": prices + ALL_K,
        "neighbour_lists": nested
        + "\nSELECT src, count(*) n, string_agg(dst::VARCHAR || ':' || round(dist*1e6)::BIGINT::VARCHAR, ',' ORDER BY rk) neighbours FROM t GROUP BY src",
        "neighbour_report": nested
        + "\nSELECT src, 'SourceID:' || src::VARCHAR || chr(10) || string_agg('NeighbourID:' || dst::VARCHAR || '+++NeighbourDistance' || round(dist*1e6)::BIGINT::VARCHAR || chr(10), '' ORDER BY rk) report FROM t GROUP BY src",
        "radius_join": _radius_sql("embeddings", 0.05),
        "radius_join_part": _radius_sql("part", 1.0),
        "radius_join_exclude_self": _radius_sql("customer", 2.0, "a.id <> b.id"),
        "radius_places": f"""WITH d AS ({VIEW_SQL['calendar']}),
p AS (SELECT x, y, count(*) n FROM d GROUP BY x, y)
SELECT a.x src_x, a.y src_y, a.n src_n, b.x dst_x, b.y dst_y, b.n dst_n, {DIST} dist
FROM p a JOIN p b ON {DIST} <= 2.0""",
        "radius_places_expanded": _radius_sql("segments", 1.0, "a.id <> b.id"),
        "index_radius": f"""WITH p AS ({VIEW_SQL['customer']}), q AS ({VIEW_SQL['supplier']})
SELECT a.id src, b.id dst, {DIST} dist, 'supplier' search FROM q a JOIN p b ON {DIST} <= 20.0
UNION ALL SELECT a.id, b.id, {DIST}, 'customer' FROM p a JOIN p b ON {DIST} <= 2.0 AND a.id <> b.id""",
        "radius_join_dedup_sources": f"""WITH p AS ({VIEW_SQL['nations']}),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY x DESC, y DESC) n FROM p) WHERE n = 1)
SELECT a.id src, b.id dst, {DIST} dist FROM r a JOIN p b ON {DIST} <= 100.0""",
        "grid_histogram_odd": f"""WITH p AS (SELECT {ODD_X} x, y FROM ({VIEW_SQL['embeddings']})),
q AS (SELECT * FROM p WHERE isfinite(x)), b AS (SELECT min(x) x0, max(x) x1, min(y) y0, max(y) y1 FROM q),
c AS (SELECT floor((x-x0)/((x1-x0)/100))::BIGINT cx, floor((y-y0)/((y1-y0)/100))::BIGINT cy FROM q CROSS JOIN b
  UNION ALL SELECT NULL, NULL FROM p WHERE isfinite(x) IS NOT TRUE)
SELECT cx, cy, count(*) n FROM c GROUP BY cx, cy""",
        "point_stats_odd": stats.format(view=f"SELECT * FROM (SELECT {ODD_X} x, y FROM ({VIEW_SQL['customer']})) WHERE isfinite(x)", k=K),
        "ring_assign_odd": f"""WITH p AS (SELECT id, {ODD_X} x, y FROM ({VIEW_SQL['customer']})),
q AS (SELECT id, x*x+y*y "key" FROM p WHERE isfinite(x)),
b AS (SELECT min("key") mn, (max("key")-min("key"))/greatest(1, floor(count(*)/{K})) width FROM q)
SELECT id, floor(("key"-mn)/width)::BIGINT home FROM q CROSS JOIN b
UNION ALL SELECT id, NULL FROM p WHERE x IS NOT NULL AND NOT isfinite(x)""",
        "knn_beyond": f"""WITH r AS (SELECT id, x + 1000 x, y FROM ({VIEW_SQL['customer']})), s AS ({VIEW_SQL['part']}),
c AS (SELECT a.id src, b.id dst, {DIST} dist FROM r a CROSS JOIN s b),
{DISTINCT_K}""",
        "knn_vec_ties": f"""WITH p AS (SELECT vec_id id, list_transform(embedding::DOUBLE[], lambda x: round(x * 4) * 0.3) v FROM embeddings),
c AS (SELECT a.id src, b.id dst, sqrt(list_sum(list_transform(range(1, 17),
  lambda i: (a.v[i]-b.v[i])*(a.v[i]-b.v[i])))) dist FROM p a JOIN p b ON a.id <> b.id),
{DISTINCT_K}""",
        "knn_exact_lineitem": _near_sql("lineitem"),
        "radius_join_capped": f"""WITH c AS ({_radius_sql("embeddings", 0.05)}),
{ALL_K}""",
        "grid_histogram": _grid_ctes("part") + "\nSELECT cx, cy, count(*) n FROM c GROUP BY cx, cy",
        "grid_histogram_embeddings": _grid_ctes("embeddings")
        + "\nSELECT cx, cy, count(*) n FROM c GROUP BY cx, cy",
        "grid_histogram_clamped": _grid_ctes("lineitem")
        + "\nSELECT least(cx, 99) cx, least(cy, 99) cy, count(*) n FROM c GROUP BY 1, 2",
        "dedup_last": f"""SELECT {', '.join(DEDUP_COLUMNS)} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
ORDER BY {', '.join(c + ' DESC' for c in DEDUP_COLUMNS[1:])}) n FROM lineitem) WHERE n = 1""",
        "dedup_lines": f"""SELECT id, x, y FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY x DESC, y DESC) n
FROM ({VIEW_SQL['lineitem']})) WHERE n = 1""",
        "read_points": VIEW_SQL["part"],
        "upsample_counts": _grid_ctes("embeddings")
        + "\nSELECT cx, cy, count(*) * 5 n FROM c GROUP BY cx, cy",
        "upsample_ids": "SELECT count(*) * 5 n, count(*) * 5 ids, 1::BIGINT first_id, count(*) * 5 last_id FROM embeddings",
    }
    for view in ("part", "customer", "embeddings"):
        sql[f"knn_ring_{view}"] = _ring_sql(view)
        sql[f"knn_ring_relative_{view}"] = _ring_sql(view, "relative")
    if llm is not None:
        sql |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the five nearest parts of every part, exactly."""
    return queries()["knn_exact_part"](spark, "/root/testdata/sf0.001")

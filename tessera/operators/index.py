"""A point index: tiles on disk, made once and searched many times.

The index is a folder with three tables: the points in curve order, cut into tiles
and stored by blocks of tiles (a partition column); the boxes of the tiles and of
the levels above them; and a manifest of one row, written last. A search descends
the stored boxes and then reads the blocks that it reaches, no others.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.cells import Box
from tessera.operators.radius import TILE, extent, not_itself, usable
from tessera.plans.cut import place, written
from tessera.plans.tiles import Packed, Plane, levels, matches, pack, tile_pairs

#: Blocks of an index, at most: what bounds its folders and the list that a search collects.
BLOCKS = 4096
#: Tiles of a block, at least.
BLOCK_TILES = 512


@dataclass(frozen=True)
class PointIndex:
    """An opened index: ``rows`` (id, g, x, y, tile, block), ``nodes`` and what the manifest says."""

    rows: DataFrame
    nodes: DataFrame
    counts: list[int]
    box: Box
    size: int
    n_rows: int
    block_tiles: int
    path: str

    def within(self, blocks: Sequence[int]) -> DataFrame:
        """The rows of some blocks; other blocks are not read."""
        return self.rows.where(F.col("block").isin(list(blocks)))


def build_index(points: DataFrame, path: str | None = None) -> PointIndex:
    """Write an index of ``points`` (id, x, y) to a new folder and open it.

    Without a path it goes to the folder for intermediate tables and is deleted
    with these. Points without finite coordinates are left out, as nothing is near
    them. Repeated rows stay; other columns are dropped; no points make an index
    that finds nothing.
    """
    spark = points.sparkSession
    path = path or place(spark, "index")
    rows = usable(points)
    box, n = extent(rows)
    packed = pack(rows, n, box, TILE, Plane(), tie_break=["id"])
    stored = packed.rows.select("id", "g", "x", "y", "tile", "rank")
    nodes, counts = levels(packed, stored)
    block_tiles = max(BLOCK_TILES, -(-packed.n_tiles // BLOCKS))
    stored = stored.withColumn("block", F.floor(F.col("tile") / block_tiles))
    # Runs of ranks are equally long, however crowded a place is.
    stored.repartitionByRange(packed.tasks, "rank").sortWithinPartitions("rank").drop("rank").write.partitionBy(
        "block"
    ).parquet(f"{path}/rows")
    nodes.write.parquet(f"{path}/nodes")
    manifest = {
        "rows": stored.drop("rank").schema.json(),
        "nodes": nodes.schema.json(),
        "counts": counts,
        "box": [box.x_min, box.x_max, box.y_min, box.y_max],
        "size": packed.size,
        "n_rows": packed.n_rows,
        "block_tiles": block_tiles,
    }
    spark.range(1).select(F.lit(json.dumps(manifest)).alias("manifest")).write.parquet(f"{path}/manifest")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> PointIndex:
    """Open an index that ``build_index`` has written, also in an earlier session."""
    kept = json.loads(spark.read.parquet(f"{path}/manifest").first()["manifest"])

    def table(name: str) -> DataFrame:
        return spark.read.schema(T.StructType.fromJson(json.loads(kept[name]))).parquet(f"{path}/{name}")

    return PointIndex(
        table("rows"), table("nodes"), kept["counts"], Box(*kept["box"]), kept["size"], kept["n_rows"], kept["block_tiles"], path
    )


def _reach(index: PointIndex, queries: DataFrame, radius: float) -> tuple[Packed, DataFrame, DataFrame, list[int]]:
    """The queries in tiles with their bound, the pairs of tiles to compare, and the blocks these lie in."""
    if not radius >= 0:
        raise ValueError("radius must not be negative")
    rows = usable(queries)
    box, n = extent(rows)
    packed = pack(rows, n, box, index.size, Plane(), tie_break=["id"])
    packed = replace(packed, n_targets=index.n_rows, stored=(index.nodes, index.counts))
    probes = packed.rows.withColumn("bound", F.lit(float(radius)))
    pairs = written(tile_pairs(packed, probes, index.rows), "pairs")
    reached = pairs.select(F.floor(F.col("tile") / index.block_tiles).alias("block")).distinct()
    # At most BLOCKS numbers.
    return packed, probes, pairs, sorted(r["block"] for r in reached.collect())


def blocks_reached(index: PointIndex, queries: DataFrame, radius: float) -> list[int]:
    """The blocks of the index that a search reads."""
    return _reach(index, queries, radius)[-1]


def radius_search(index: PointIndex, queries: DataFrame, radius: float, exclude_self: bool = False) -> DataFrame:
    """Every query with every indexed point at most ``radius`` away: src, dst, dist.

    The rows of ``radius_join(queries, points, radius)``; queries without finite
    coordinates find nothing.
    """
    packed, probes, pairs, blocks = _reach(index, queries, radius)
    condition = not_itself() if exclude_self else None
    found = matches(packed, probes, index.within(blocks), ["id"], ["id"], condition, pairs=pairs)
    return found.select(F.col("q_id").alias("src"), F.col("t_id").alias("dst"), "dist")

"""Packed tiles: an exact spatial join that no hot place can overload.

Rows are sorted along a Z-order curve and cut into runs of equal length, the
tiles, as in a packed R-tree (Kamel and Faloutsos, VLDB 1994). A tile is a run
of ranks and not a region of space, so it never holds more than ``size`` rows
however dense the data is. Runs of ``FAN`` tiles form the next level, and so on
up to a level with at most ``TOP`` nodes; the parent of node ``i`` is simply
``i div FAN``.

A search descends that hierarchy one level at a time, for whole tiles of
sources at once, and keeps the nodes whose box lies within the search bound.
Every step is an equi-join on a node number, so no plan holds a nested-loop
join between point sets.

Column conventions: ``g`` group that neighbours must share (BIGINT), ``x`` and
``y`` coordinates used for pruning, optionally ``v`` the full vector.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.cells import Box, with_zkey
from tessera.functions.metrics import euclidean, euclidean_vec, gap
from tessera.plans import plane_kernel, vector_kernel
from tessera.plans.cut import written
from tessera.plans.skew import copy, deal, hot_keys, salted_join

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(plane_kernel)
cloudpickle.register_pickle_by_value(vector_kernel)

FAN = 16
TOP = 64

# A tile searched by at most this many source tiles needs no salting.
BUSY = 1 << 10

# Levels with at most this many nodes go to all tasks: few keys would be few tasks.
FEW_NODES = 1 << 12

# A row costs hundreds of distances, so partitions are sized by rows, not bytes.
ROWS_PER_TASK = 16384

# Partitions for each shuffle partition of the session, at most: what bounds shuffles and the driver's rows.
TASKS_PER_PARTITION = 16

# Vectors are met by larger tiles, as a kernel compares whole tiles at once.
VECTOR_TILE = 128

# monotonically_increasing_id keeps the position in the partition in 33 bits.
_ROW_MASK = (1 << 33) - 1


@dataclass(frozen=True)
class Plane:
    """Points in the plane: distance and pruning both use ``x`` and ``y``."""

    columns: tuple[str, ...] = ("x", "y")

    def distance(self, a, b) -> Column:
        return euclidean(a("x"), a("y"), b("x"), b("y"))

    def apart(self, dx: Column, dy: Column) -> Column:
        """Smallest possible distance given the gaps along both axes."""
        return F.sqrt(dx * dx + dy * dy)

    def reach(self, bound: Column, box: Box) -> Column:
        return bound


@dataclass(frozen=True)
class Pivoted:
    """Vectors ``v``; ``x`` and ``y`` are the distances to two fixed vectors.

    By the triangle inequality the true distance is at least the difference of
    the distances to a pivot, so the larger gap is a safe lower bound. The
    slack covers rounding in the pivot distances.
    """

    m: int
    columns: tuple[str, ...] = ("x", "y", "v")
    # A centre and an orthonormal basis, directions of large variance first.
    mean: np.ndarray | None = field(default=None, compare=False)
    basis: np.ndarray | None = field(default=None, compare=False)

    def distance(self, a, b) -> Column:
        return euclidean_vec(a("v"), b("v"), self.m)

    def apart(self, dx: Column, dy: Column) -> Column:
        return F.greatest(dx, dy)

    def reach(self, bound: Column, box: Box) -> Column:
        return bound * F.lit(1 + 1e-9) + F.lit(box.reach * 1e-9)


@dataclass(frozen=True)
class Packed:
    """Rows in curve order, written out.

    ``rank`` numbers all rows, ``slot`` counts the target rows before a row, and
    ``tile`` is the target tile at that place; ``a`` is the source tile.
    """

    rows: DataFrame
    box: Box
    size: int
    n_rows: int
    n_targets: int
    widest: int
    shape: Plane | Pivoted
    one_sided: bool
    tasks: int
    # Nodes and their number per level, where the targets are a stored index.
    stored: tuple[DataFrame, list[int]] | None = None

    @property
    def n_tiles(self) -> int:
        """Tiles of ``size`` targets; the last one also has the rest."""
        return max(1, self.n_targets // self.size) if self.n_targets else 0


def pack(
    rows: DataFrame,
    n_rows: int,
    box: Box,
    size: int,
    shape: Plane | Pivoted,
    *,
    tie_break: Sequence[str] = (),
    target: Column | None = None,
    width: Column | None = None,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
) -> Packed:
    """Sort ``rows`` along the curve, number them and write them.

    ``size`` is a power of two. ``n_rows`` is a row count, exact or too high, to size the work by.
    ``target`` marks the rows that can be found; without it every row can.
    ``width`` is an integer per row whose maximum is reported as ``widest``.
    ``enrich`` adds columns while the rows pass by in curve order.
    The sort key ends in columns that tell all rows apart, so that range
    partitions stay even where many rows share a place.
    """
    order = ["g", "z", *shape.columns, *tie_break]
    most = TASKS_PER_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(n_rows // ROWS_PER_TASK, most))
    placed = (
        with_zkey(rows, box)
        .repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK)))
    )
    if target is None:
        placed = placed.withColumn("ahead", F.col("row"))
        found = F.lit(1)
    else:
        before = Window.partitionBy("part").orderBy("row").rowsBetween(
            Window.unboundedPreceding, -1
        )
        found = target.cast("int")
        placed = placed.withColumn(
            "ahead", F.coalesce(F.sum(found.cast("long")).over(before), F.lit(0))
        )
    placed = placed.drop("z")
    table = written(placed if enrich is None else enrich(placed), "packed")
    # One row per range partition, so at most ``most``.
    per_part = table.groupBy("part").agg(
        F.count("*").alias("n"),
        F.sum(found).alias("found"),
        F.max(F.lit(1) if width is None else width).alias("width"),
    )
    parts = sorted(per_part.collect(), key=lambda p: p["part"])
    if any(p["n"] > _ROW_MASK for p in parts):
        raise ValueError(f"a range partition has more than {_ROW_MASK} rows")
    starts, slots, n_rows, n_targets = [], [], 0, 0
    for p in parts:
        starts.append(n_rows)
        slots.append(n_targets)
        n_rows += p["n"]
        n_targets += p["found"]
    offsets = table.sparkSession.createDataFrame(
        pa.table(
            {
                "part": pa.array([p["part"] for p in parts], pa.int32()),
                "start": pa.array(starts, pa.int64()),
                "slots": pa.array(slots, pa.int64()),
            }
        )
    )
    bits = size.bit_length() - 1
    slot = F.col("slots") + F.col("ahead")
    numbered = (
        table.join(F.broadcast(offsets), "part")
        .withColumn("rank", F.col("start") + F.col("row"))
        .withColumn("a", F.shiftright("rank", bits))
        .withColumn("tile", F.least(F.shiftright(slot, bits), F.lit(max(n_targets // size - 1, 0)).cast("long")))
        .drop("part", "row", "start", "slots", "ahead")
    )
    widest = max((p["width"] or 0 for p in parts), default=0)
    return Packed(numbered, box, size, n_rows, n_targets, widest, shape, target is None, tasks)


def _box(prefix: str = "") -> list[Column]:
    """Aggregates for the box and group range of a run of rows."""
    return [
        agg(c).alias(f"{prefix}{c}_{end}")
        for c in ("x", "y", "g")
        for agg, end in ((F.min, "lo"), (F.max, "hi"))
    ]


def levels(packed: Packed, targets: DataFrame) -> tuple[DataFrame, list[int]]:
    """All nodes of the hierarchy as one table, and the node count per level."""
    if packed.stored is not None:
        return packed.stored
    counts = [packed.n_tiles]
    while counts[-1] > TOP:
        counts.append(-(-counts[-1] // FAN))
    leaves = targets.groupBy("tile").agg(*_box())
    if len(counts) == 1:
        return leaves.withColumnRenamed("tile", "node").withColumn("level", F.lit(0)), counts
    bits = FAN.bit_length() - 1
    nodes = (
        leaves.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(len(counts) - 1))))
        .withColumn("node", F.expr(f"shiftright(tile, {bits} * level)"))
        .groupBy("level", "node")
        .agg(
            *[F.min(f"{c}_lo").alias(f"{c}_lo") for c in ("x", "y", "g")],
            *[F.max(f"{c}_hi").alias(f"{c}_hi") for c in ("x", "y", "g")],
        )
    )
    # Every level reads the nodes again, which pays for a write beyond two levels.
    return (written(nodes, "nodes") if len(counts) > 2 else nodes), counts


def tile_pairs(packed: Packed, probes: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs of a source tile ``a`` and a target tile that may hold a match.

    ``probes`` has one row per source: ``a``, ``g``, ``x``, ``y`` and the search
    bound ``bound``. The result carries the box of the target tile.
    """
    nodes, counts = levels(packed, targets)
    top = len(counts) - 1
    sources = probes.groupBy("a").agg(*_box("p_"), F.max("bound").alias("bound"))
    # Few rows that fan out: deal them over all tasks.
    sources = sources.repartition(packed.tasks)
    gaps = [
        gap(F.col(f"{c}_lo"), F.col(f"{c}_hi"), F.col(f"p_{c}_lo"), F.col(f"p_{c}_hi"))
        for c in ("x", "y")
    ]
    near = (
        (F.col("g_lo") <= F.col("p_g_hi"))
        & (F.col("g_hi") >= F.col("p_g_lo"))
        & (packed.shape.apart(*gaps) <= packed.shape.reach(F.col("bound"), packed.box))
    )
    frontier = sources.withColumn(
        "node", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(counts[top] - 1, 0)).cast("long")))
    )
    box_columns = [f"{c}_{end}" for c in ("x", "y", "g") for end in ("lo", "hi")]
    for level in range(top, -1, -1):
        at_level = nodes.where(F.col("level") == level).drop("level")
        if counts[level] <= FEW_NODES:
            at_level = F.broadcast(at_level)
        frontier = frontier.join(at_level, "node").where(near)
        if level:
            first = F.col("node") * FAN
            last = F.least(first + (FAN - 1), F.lit(counts[level - 1] - 1))
            frontier = frontier.drop(*box_columns).withColumn(
                "node", F.explode(F.sequence(first, last))
            )
    return frontier.select("a", F.col("node").alias("tile"), *box_columns)


def matches(
    packed: Packed,
    probes: DataFrame,
    targets: DataFrame,
    keep_source: Sequence[str],
    keep_target: Sequence[str],
    condition: Column | None = None,
    pairs: DataFrame | None = None,
    crowded: bool = False,
) -> DataFrame:
    """All (source, target) rows of a group within the bound of the source.

    Result columns: ``q_<c>`` for every source column kept, ``t_<c>`` for every
    target column kept, and ``dist``. ``condition`` may use the ``q_`` and ``t_``
    names and is evaluated inside the join. ``pairs`` are the written ``tile_pairs``,
    where they are known already. ``crowded``: a row has many matches, so that tasks are
    sized by rows where both sides are shuffled.
    """
    shape = packed.shape
    known = pairs is not None
    pairs = pairs if known else tile_pairs(packed, probes, targets)
    join_on, source_on = ["tile"], ["a"]
    n_source_tiles = -(-packed.n_rows // packed.size)
    busy = n_source_tiles > BUSY
    if busy:
        pairs = pairs if known else written(pairs, "pairs")
        hot = hot_keys(pairs, ["tile"], BUSY)
        # Source tiles that search very many tiles are dealt out as well.
        wide = hot_keys(pairs, ["a"], BUSY)
        pairs = deal(pairs, hot, ["tile"], ["a"])
        pairs = deal(pairs.withColumnRenamed("_salt", "_t_salt"), wide, ["a"], ["tile"])
        pairs = pairs.withColumnsRenamed({"_salt": "_a_salt", "_t_salt": "_salt"})
        targets = copy(targets, hot, ["tile"])
        join_on, source_on = ["tile", "_salt"], ["a", "_a_salt"]

    places = ["g", *shape.columns]
    q = probes.select(
        "a",
        F.col("bound").alias("q_bound"),
        *[F.col(c).alias(f"q_{c}") for c in dict.fromkeys([*places, *keep_source])],
    )
    t = targets.select(
        *join_on, *[F.col(c).alias(f"t_{c}") for c in dict.fromkeys([*places, *keep_target])]
    )
    if crowded:
        t = t.repartition(packed.tasks, *join_on)
    inside = (F.col("q_g") >= F.col("g_lo")) & (F.col("q_g") <= F.col("g_hi"))
    gaps = [
        gap(F.col(f"{c}_lo"), F.col(f"{c}_hi"), F.col(f"q_{c}"), F.col(f"q_{c}"))
        for c in ("x", "y")
    ]
    within = shape.apart(*gaps) <= shape.reach(F.col("q_bound"), packed.box)
    box_columns = [f"{c}_{end}" for c in ("x", "y", "g") for end in ("lo", "hi")]
    if busy:
        q = copy(q, wide, ["a"]).withColumnRenamed("_salt", "_a_salt")
    visits = q.repartition(packed.tasks, *source_on).join(pairs, source_on).where(inside & within)
    visits = visits.drop(*source_on, *box_columns)
    dist = shape.distance(lambda c: F.col(f"q_{c}"), lambda c: F.col(f"t_{c}"))
    wanted = (F.col("q_g") == F.col("t_g")) & (dist <= F.col("q_bound"))
    if condition is not None:
        wanted = wanted & condition
    # A filter straight above an inner join becomes part of the join, so pairs
    # out of reach are dropped before a joined row is built.
    return (
        visits.join(t, join_on)
        .where(wanted)
        .select(
            *[f"q_{c}" for c in keep_source],
            *[f"t_{c}" for c in keep_target],
            dist.alias("dist"),
        )
    )


# Rows of a block in the plane, and the blocks' worth of targets that may meet it in one task.
PLANE_BLOCK = 1 << 13
PLANE_REACH = 4


def plane_nearest(packed: Packed, probes: DataFrame, k: int) -> tuple[DataFrame, DataFrame | None]:
    """For points of one side: every place with its ``k`` smallest distinct distances in ``others``.

    Runs of tiles form blocks. A row is sent to its own block, and once to every other block that
    reaches its tile, so a source has all its candidates in one task (``plane_kernel.py``) and
    only its nearest leave it. A block that reaches more than ``PLANE_REACH`` times its tiles meets
    the reached tiles of one other block at a time instead.

    Gives ``rank, g, x, y, r_ids, others``. The second table, if there are such wide blocks, has
    their places, once per block met: the nearest of a place are among its rows.
    """
    tile_bits = packed.size.bit_length() - 1
    bits = max(PLANE_BLOCK.bit_length() - 1 - tile_bits, 0)
    most = PLANE_REACH << bits

    def block(tile: str) -> Column:
        return F.shiftright(tile, bits)

    first = F.get("r_ids", F.lit(0)).alias("first")
    own = probes.select(block("a").alias("block"), "a", "rank", "g", "x", "y", "bound", "r_ids", first)
    targets = probes.select("tile", "rank", "g", "x", "y", first)
    pairs = tile_pairs(packed, probes, probes).select("a", "tile")
    wide = None
    if packed.n_tiles > most:
        pairs = written(pairs, "pairs")
        counts = pairs.select(block("a").alias("block"), "tile").distinct().groupBy("block").count()
        # One row per block at most.
        wide = written(counts.where(F.col("count") > most).select("block"), "wide")
        wide = None if wide.isEmpty() else F.broadcast(wide)
    id_type = own.schema["first"].dataType.simpleString()
    ids_type = own.schema["r_ids"].dataType.simpleString()
    schema = f"rank long, g long, x double, y double, r_ids {ids_type}, others array<struct<dist: double, dst: {id_type}>>"

    def solved(sources: DataFrame, met: DataFrame, by: list[str], among: bool) -> DataFrame:
        # New names apart, as both sides come from one table.
        grouped = [
            df.select(*[F.col(c).alias(c) for c in df.columns]).repartition(packed.tasks, *by).groupBy(*by)
            for df in (sources, met)
        ]
        return grouped[0].cogroup(grouped[1]).applyInArrow(plane_kernel.search(k, tile_bits, among), schema)

    reached = pairs.select(block("a").alias("block"), "tile").distinct()
    beside = reached.where(F.col("block") != block("tile"))
    if wide is not None:
        beside = beside.join(wide, "block", "left_anti")
    narrow = own if wide is None else own.join(wide, "block", "left_anti")
    found = solved(narrow.drop("a"), targets.join(beside, "tile").drop("tile"), ["block"], True)
    if wide is None:
        return found, None
    parts = pairs.select("a", block("tile").alias("part")).distinct()
    sources = own.join(wide, "block").join(parts, "a").drop("a")
    met = targets.join(reached.join(wide, "block"), "tile").withColumn("part", block("tile")).drop("tile")
    return found, solved(sources, met, ["block", "part"], False)


# Blocks of sources and of targets, about, from FEW_ROWS a block on and until one has BLOCK_BYTES of
# coordinates: what is shuffled grows with the rows, and not with the number of pairs of tiles.
BLOCKS = 8
FEW_ROWS = 1 << 12
BLOCK_BYTES = 1 << 26


def vector_matches(
    packed: Packed, probes: DataFrame, targets: DataFrame, k: int, ties: str, count: bool = False
) -> DataFrame:
    """For vectors: rows that hold the ``k`` nearest of every source, with ``q_rank, t_s_ids, dist``.

    Runs of tiles form blocks, about ``BLOCKS`` of them on either side. Blocks of sources
    find target tiles as in ``matches``; a block of sources then meets the rows that it
    reaches of one block of targets in a kernel that computes few distances in full
    (``vector_kernel.py``). A row is sent once per block of the other side, and a meeting
    gives at most ``k`` rows per source. ``count`` gives the work done instead: ``pairs,
    leading, whole`` distances.
    """
    shape = packed.shape
    tile_bits = packed.size.bit_length() - 1
    most = min(max(packed.n_rows // BLOCKS, FEW_ROWS), BLOCK_BYTES // (8 * max(shape.m, 1)))
    bits = max(most.bit_length() - 1 - tile_bits, 0)

    def blocks(tiles: int) -> int:
        return max(1, -(-tiles >> bits))

    n_sources, n_parts = blocks(-(-packed.n_rows // packed.size)), blocks(packed.n_tiles)
    probes = probes.withColumn("a", F.shiftright("a", bits))
    pairs = tile_pairs(packed, probes, targets).select("a", "tile", F.shiftright("tile", bits).alias("part"))
    if n_parts > 1:
        pairs = written(pairs, "pairs")
    met = pairs.join(targets.select("tile", "rank", "x", "y", "v", "s_ids"), "tile").drop("tile")
    sources = probes.select("a", "rank", "x", "y", "v", "bound")
    if n_parts > 1:
        sources = sources.join(pairs.select("a", "part").distinct(), "a")
    else:
        sources = sources.withColumn("part", F.lit(0).cast("long"))
    if count:
        schema = "pairs long, leading long, whole long"
    else:
        schema = f"q_rank long, t_s_ids {targets.schema['s_ids'].dataType.simpleString()}, dist double"
    slack = packed.box.reach * 1e-9
    search = vector_kernel.search(k, ties == "distinct", shape.mean, shape.basis, slack, count)
    # New names apart, as both sides come from one table.
    grouped = [
        df.select(*[F.col(c).alias(c) for c in df.columns])
        .repartition(n_sources * n_parts, "a", "part")
        .groupBy("a", "part")
        for df in (sources, met)
    ]
    return grouped[0].cogroup(grouped[1]).applyInArrow(search, schema)

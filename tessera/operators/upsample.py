"""Grow a point set while keeping its spatial density."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.grid import bounding_box, grid_histogram
from tessera.plans.cut import written

# Longest array built while counting out the points of a cell.
RUN = 1 << 16

# Points that one task makes, about.
TASK = 1 << 20


def _uniform(seed: int, axis: int) -> Column:
    """Number in [0, 1) that depends on the seed, the point id and the axis only."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("id"), F.lit(axis)), 11)
    return bits.cast("double") * F.lit(2.0**-53)


def upsample(
    points: DataFrame,
    factor: int = 5,
    nx: int = 100,
    ny: int = 100,
    seed: int = 42,
    clamp: bool = False,
    box: DataFrame | None = None,
) -> DataFrame:
    """``factor`` new points per input point, uniform in the cell of the input.

    ``box`` is a one-row bounding box to lay the grid over; by default that of
    the points. Points without finite coordinates have no cell and do not grow.
    Ids are dense from 1. Cells are counted out in runs of at most ``RUN``
    points, dealt over tasks of about ``TASK`` points each, so a cell that holds
    most of the data does not land in one task.
    """
    bounds = bounding_box(points) if box is None else box
    cells = grid_histogram(points, nx, ny, clamp, bounds).where("cx IS NOT NULL AND cy IS NOT NULL")
    total = F.col("n") * F.lit(factor)
    # Cells are numbered by range partitions; the driver sees none of them.
    placed = written(
        cells.withColumn("total", total).repartitionByRange("cx", "cy").withColumn("part", F.spark_partition_id()),
        "cells",
    )
    parts = placed.groupBy("part").agg(F.sum("total").alias("sum"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    before = Window.partitionBy("part").orderBy("cx", "cy").rowsBetween(Window.unboundedPreceding, -1)
    sized = placed.join(F.broadcast(offsets), "part").withColumn(
        "start", F.col("offset") + F.coalesce(F.sum("total").over(before), F.lit(0))
    )
    # A number of its own keeps adaptive execution from merging the small counter rows.
    tasks = max(1, -(-(placed.agg(F.sum("total")).first()[0] or 0) // TASK))

    def spread(df: DataFrame, count: Column, name: str) -> DataFrame:
        steps = F.sequence(F.lit(0).cast("long"), count - 1)
        return df.where(count > 0).withColumn(name, F.explode(steps))

    # Three nested counters, each below RUN: blocks of runs, runs, points.
    blocks = spread(sized, F.ceil(F.col("total") / (RUN * RUN)), "block")
    full = F.lit(RUN).cast("long")
    left = F.col("total") - F.col("block") * (RUN * RUN)
    in_block = F.least(F.ceil(F.col("left") / RUN), full)
    runs = spread(blocks.withColumn("left", left), in_block, "run")
    dealt = runs.repartition(tasks, "cx", "cy", "block", "run")
    counted = spread(dealt, F.least(F.col("left") - F.col("run") * RUN, full), "i")
    numbered = counted.withColumn(
        "id", F.col("start") + F.col("block") * (RUN * RUN) + F.col("run") * RUN + F.col("i") + 1
    )
    one = bounds.select(F.struct("min_x", "max_x", "min_y", "max_y").alias("box")).scalar()
    edge_x = (one["max_x"] - one["min_x"]) / F.lit(nx)
    edge_y = (one["max_y"] - one["min_y"]) / F.lit(ny)
    return numbered.select(
        "id",
        (one["min_x"] + (F.col("cx") + _uniform(seed, 0)) * edge_x).alias("x"),
        (one["min_y"] + (F.col("cy") + _uniform(seed, 1)) * edge_y).alias("y"),
    )

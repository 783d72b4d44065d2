"""Bounding box and grid histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.cells import finite, grid_cell


def bounding_box(points: DataFrame) -> DataFrame:
    """One row: min_x, max_x, min_y, max_y, of the points with finite coordinates."""
    usable = finite(F.col("x"), F.col("y"))
    return points.agg(
        *[
            agg(F.when(usable, F.col(c))).alias(f"{name}_{c}")
            for c in ("x", "y")
            for agg, name in ((F.min, "min"), (F.max, "max"))
        ]
    )


def grid_cells(
    points: DataFrame,
    nx: int = 100,
    ny: int = 100,
    clamp: bool = False,
    box: DataFrame | None = None,
) -> DataFrame:
    """Points with their cell ``cx``, ``cy`` on an ``nx`` x ``ny`` grid.

    ``box`` is a one-row bounding box; by default that of the points. A point
    without finite coordinates has no cell (nulls) and does not change the others'.
    """
    bounds = bounding_box(points) if box is None else box
    one = bounds.select(F.struct("min_x", "max_x", "min_y", "max_y").alias("box")).scalar()
    usable = finite(F.col("x"), F.col("y"))
    return points.withColumns(
        {
            "cx": F.when(usable, grid_cell(F.col("x"), one["min_x"], one["max_x"], nx, clamp)),
            "cy": F.when(usable, grid_cell(F.col("y"), one["min_y"], one["max_y"], ny, clamp)),
        }
    )


def grid_histogram(
    points: DataFrame,
    nx: int = 100,
    ny: int = 100,
    clamp: bool = False,
    box: DataFrame | None = None,
) -> DataFrame:
    """Points per occupied cell: cx, cy, n. Ids are not deduplicated here.

    Points without finite coordinates count under the cell of nulls.
    """
    return (
        grid_cells(points.select("x", "y"), nx, ny, clamp, box)
        .groupBy("cx", "cy")
        .agg(F.count("*").alias("n"))
    )

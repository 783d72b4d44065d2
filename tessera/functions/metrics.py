"""Distances between points, as column expressions that stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def euclidean(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Straight-line distance between (ax, ay) and (bx, by)."""
    dx, dy = ax - bx, ay - by
    return F.sqrt(dx * dx + dy * dy)


def euclidean_vec(a: Column, b: Column, m: int) -> Column:
    """Straight-line distance over the first ``m`` coordinates of two arrays."""
    squares = F.zip_with(
        F.slice(a, 1, m), F.slice(b, 1, m), lambda p, q: (p - q) * (p - q)
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, s: total + s))


def gap(low: Column, high: Column, other_low: Column, other_high: Column) -> Column:
    """Empty space between two intervals, 0 where they touch or overlap.

    Subtraction rounds monotonically, so this never exceeds the computed
    difference of two values taken from the intervals.
    """
    return F.greatest(F.lit(0.0), low - other_high, other_low - high)

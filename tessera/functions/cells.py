"""Ring keys and ring numbers, grid cells, and the Z-order key."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Each axis keeps 31 bits, so two interleaved axes fit a positive BIGINT.
AXIS_BITS = 31


def finite(*values: Column) -> Column:
    """All values are numbers: neither null nor NaN nor infinite."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.abs(v) < float("inf"), F.lit(False)) for v in values])


def ring_key(x: Column, y: Column) -> Column:
    """Squared distance from the origin."""
    return x * x + y * y


def ring_id(key: Column, low: Column, width: Column) -> Column:
    """Number of the ring that holds ``key``; ring 0 when rings have no width.

    A key that is no finite number has no ring (null).
    """
    return F.when(finite(key), F.coalesce(F.floor(F.try_divide(key - low, width)), F.lit(0)))


def grid_cell(value: Column, low: Column, high: Column, n: int, clamp: bool) -> Column:
    """Cell number along one axis split into ``n`` equal cells.

    The largest value falls into cell ``n``; ``clamp`` moves it into the last
    regular cell, ``n - 1``. An axis without extent has the single cell 0. A
    value that is no finite number has no cell (null).
    """
    edge = F.abs(low - high) / F.lit(n)
    cell = F.coalesce(F.floor(F.try_divide(value - low, edge)), F.lit(0))
    return F.when(finite(value), F.least(cell, F.lit(n - 1)) if clamp else cell)


@dataclass(frozen=True)
class Box:
    """Bounding box of a point set, held on the driver (four numbers)."""

    x_min: float
    x_max: float
    y_min: float
    y_max: float

    @property
    def extent(self) -> float:
        return max(self.x_max - self.x_min, self.y_max - self.y_min)

    @property
    def reach(self) -> float:
        return max(abs(v) for v in (self.x_min, self.x_max, self.y_min, self.y_max))


def with_zkey(df: DataFrame, box: Box, name: str = "z") -> DataFrame:
    """Add the Z-order key of ``x``, ``y``: the bits of both axes interleaved.

    Neighbouring keys are mostly neighbouring places, which is all the callers
    need; no result depends on the key itself.
    """
    steps = float((1 << AXIS_BITS) - 1)
    # Halving first keeps the width finite for coordinates near the double limit.
    half = box.x_max / 2 - box.x_min / 2, box.y_max / 2 - box.y_min / 2
    half_extent = max(half) or 1.0

    def axis(column: str, low: float) -> Column:
        return F.expr(
            f"cast(floor(({column} / 2 - double('{low / 2!r}'))"
            f" / double('{half_extent!r}') * double('{steps!r}')) as bigint)"
        )

    out = df.withColumns({"_zx": axis("x", box.x_min), "_zy": axis("y", box.y_min)})
    # Spread 31 bits over the even positions. Every step is its own projection
    # so that a value used twice is computed once.
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        out = out.withColumns(
            {c: F.expr(f"({c} | shiftleft({c}, {shift})) & {mask}L") for c in ("_zx", "_zy")}
        )
    z = F.expr("_zx | shiftleft(_zy, 1)")
    return out.withColumn(name, z).drop("_zx", "_zy")

"""Keep one row per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_last(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last row per ``key`` in the given order; the other columns break ties.

    Runs as an aggregate with map-side combine, so copies of a hot key meet as
    one row per task.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    last = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_last"))
    return last.select(*[F.col(key) if c == key else F.col(f"_last.{c}") for c in df.columns])

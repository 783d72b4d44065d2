"""Equi-join that spreads hot keys over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_SHARE of all left rows. At most
# HOT_SHARE keys can, which bounds the broadcast list of hot keys.
HOT_SHARE = 1024


def hot_keys(left: DataFrame, on: Sequence[str], floor: int = 0) -> DataFrame:
    """Keys with more than a fixed share of the rows (and more than ``floor``).

    Has at most ``HOT_SHARE`` rows, whatever the size of ``left``. Column
    ``_parts`` says over how many salts a key is spread.
    """
    counts = left.groupBy(*on).agg(F.count("*").alias("_n"))
    share = left.agg((F.count("*") / HOT_SHARE).alias("_share")).scalar()
    limit = F.greatest(share, F.lit(float(max(floor, 1))))
    return counts.where(F.col("_n") > limit).select(
        *on, F.ceil(F.col("_n") / limit).cast("int").alias("_parts")
    )


def deal(left: DataFrame, hot: DataFrame, on: Sequence[str], spread: Sequence[str]) -> DataFrame:
    """Add ``_salt``: rows of a hot key are dealt out by the hash of ``spread``."""
    parts = F.coalesce("_parts", F.lit(1)).cast("long")
    salt = F.pmod(F.xxhash64(*spread), parts).cast("int")
    return left.join(F.broadcast(hot), list(on), "left").withColumn("_salt", salt).drop("_parts")


def copy(right: DataFrame, hot: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add ``_salt``: rows of a hot key are copied once per salt."""
    salts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    return (
        right.join(F.broadcast(hot), list(on), "left")
        .withColumn("_salt", F.explode(salts))
        .drop("_parts")
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    floor: int = 0,
) -> DataFrame:
    """Inner join of a skewed ``left`` with a ``right`` that has few rows per key.

    Keys that are not hot join as they are; nothing is dropped on either side.
    """
    hot = hot_keys(left, on, floor)
    return (
        deal(left, hot, on, spread).join(copy(right, hot, on), [*on, "_salt"]).drop("_salt")
    )

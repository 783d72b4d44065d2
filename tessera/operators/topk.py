"""k nearest per source, and nested neighbour lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TIES = ("distinct", "all")


def check_ties(ties: str) -> None:
    if ties not in TIES:
        raise ValueError(f"ties must be one of {TIES}, not {ties!r}")


def top_k(pairs: DataFrame, k: int, ties: str = "distinct", by: str = "src") -> DataFrame:
    """Keep the ``k`` smallest distances of every source.

    ``pairs`` has the columns ``by``, ``dst`` and ``dist``; the result adds the
    rank ``rk``, from 1; a null distance ranks last. With ``ties="distinct"`` equal distances of a source
    collapse into one neighbour, the one with the smallest id. With
    ``ties="all"`` every pair counts, ordered by distance and id.

    Rows are trimmed before the only shuffle: the window's rank limit runs inside each
    task first. A source with very many candidates sends at most ``k`` rows per task with
    ``ties="all"``, and with ``ties="distinct"`` those at one of the task's ``k`` smallest
    distances, which are more than ``k`` only where distances are equal.
    """
    check_ties(ties)
    if ties == "distinct":
        # Ranks that count distances once, so the limit holds for distinct ones.
        near = Window.partitionBy(by).orderBy(F.asc_nulls_last("dist"))
        first = Window.partitionBy(by, "dist").orderBy("dst")
        ranked = pairs.withColumn("rk", F.dense_rank().over(near)).where(F.col("rk") <= k)
        # The rank's exchange serves this window too.
        return (
            ranked.withColumn("_nth", F.row_number().over(first))
            .where(F.col("_nth") == 1)
            .select(by, "dst", "dist", "rk")
        )
    order = Window.partitionBy(by).orderBy(F.asc_nulls_last("dist"), "dst")
    return (
        pairs.withColumn("rk", F.row_number().over(order))
        .where(F.col("rk") <= k)
        .select(by, "dst", "dist", "rk")
    )


def neighbour_lists(neighbours: DataFrame) -> DataFrame:
    """One row per source with its neighbours nested, nearest first.

    Expects the output of a kNN operator, so at most ``k`` rows per source.
    """
    return neighbours.groupBy("src").agg(
        F.sort_array(F.collect_list(F.struct("dist", "dst"))).alias("neighbours")
    )

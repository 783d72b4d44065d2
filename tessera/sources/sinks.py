"""Writers for neighbour lists and the text report."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.topk import neighbour_lists

FORMATS = ("parquet", "json", "orc", "text")

# The labels of the text report.
SOURCE, NEIGHBOUR, DISTANCE = "SourceID:", "NeighbourID:", "+++NeighbourDistance"


def write_neighbours(neighbours: DataFrame, path: str, format: str = "parquet") -> str:
    """Write one nested record per source; returns the path used.

    The path gets the start time in milliseconds as a suffix, so that runs do
    not overwrite each other. ``text`` writes ``(src,[(dst,dist), ...])`` lines.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {format!r}")
    target = f"{path}{int(time.time() * 1000)}"
    lists = neighbour_lists(neighbours)
    if format == "text":
        pair = lambda n: F.concat(
            F.lit("("), n["dst"].cast("string"), F.lit(","), n["dist"].cast("string"), F.lit(")")
        )
        joined = F.concat_ws(", ", F.transform("neighbours", pair))
        lists = lists.select(
            F.concat(F.lit("("), F.col("src").cast("string"), F.lit(",["), joined, F.lit("])"))
        )
    lists.write.format(format).save(target)
    return target


def neighbour_report(neighbours: DataFrame, shown: Column | None = None) -> DataFrame:
    """One text record per source: a source line, then a line per neighbour.

    ``shown`` is how a distance is printed; by default the double itself.
    """
    dist = F.col("dist") if shown is None else shown
    line = F.concat(
        F.lit(NEIGHBOUR),
        F.col("dst").cast("string"),
        F.lit(DISTANCE),
        dist.cast("string"),
        F.lit("\n"),
    )
    by_rank = F.sort_array(F.collect_list(F.struct("rk", line.alias("line"))))
    body = F.concat_ws("", F.transform(by_rank, lambda n: n["line"]))
    return neighbours.groupBy("src").agg(
        F.concat(F.lit(SOURCE), F.first("src").cast("string"), F.lit("\n"), body).alias("report")
    )


def write_report(neighbours: DataFrame, path: str) -> None:
    """Write the text report."""
    neighbour_report(neighbours).select("report").write.text(path)

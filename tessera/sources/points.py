"""Points as text lines: ``<id>*;*(<x>, <y>, <more>, ...)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ON_BAD = ("fail", "drop", "keep")


def parse_points(
    lines: DataFrame, on_bad: str = "fail", id_type: str = "bigint", value: str = "value"
) -> DataFrame:
    """Turn lines into ``id``, ``x``, ``y``, ``attrs``; other columns are kept.

    A line without an id or without two numbers is bad: ``fail`` stops the query
    and names the line, ``drop`` skips it, ``keep`` returns it with null
    coordinates.
    """
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}, not {on_bad!r}")
    tokens = F.split(F.col(value), "[*]")
    place = F.get(tokens, F.lit(2))
    fields = F.split(F.substr(place, F.lit(2), F.length(place) - 2), ",")
    out = lines.withColumns(
        {
            "id": F.get(tokens, F.lit(0)).try_cast(id_type),
            "x": F.get(fields, F.lit(0)).try_cast("double"),
            "y": F.get(fields, F.lit(1)).try_cast("double"),
            "attrs": F.slice(fields, 3, F.greatest(F.size(fields) - 2, F.lit(0))),
        }
    )
    good = F.col("id").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()
    if on_bad == "drop":
        out = out.where(good)
    elif on_bad == "fail":
        # A filter, as a column that raises would be pruned where it is not asked for.
        problem = F.raise_error(F.concat(F.lit("not a point: "), F.coalesce(value, F.lit("null"))))
        out = out.where(F.when(good, True).otherwise(problem.cast("boolean")))
    else:
        out = out.withColumns({c: F.when(good, F.col(c)) for c in ("x", "y")})
    rest = [c for c in lines.columns if c != value]
    return out.select("id", "x", "y", "attrs", *rest)


def read_points(
    spark: SparkSession,
    path: str,
    on_bad: str = "fail",
    id_type: str = "bigint",
    with_position: bool = False,
) -> DataFrame:
    """Read point lines. ``with_position`` adds ``pos``, which orders lines as in
    the files: by file name, then by place in the file."""
    lines = spark.read.text(path)
    if with_position:
        lines = lines.select(
            "value",
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("pos"),
        )
    return parse_points(lines, on_bad, id_type)


def point_lines(points: DataFrame) -> DataFrame:
    """Render points as lines that ``parse_points`` reads back."""
    line = F.concat(
        F.col("id").cast("string"),
        F.lit("*;*("),
        F.col("x").cast("string"),
        F.lit(","),
        F.col("y").cast("string"),
        F.lit(",,,"),
    )
    return points.select(line.alias("value"))


def write_points(points: DataFrame, path: str) -> None:
    """Write points as text lines."""
    point_lines(points).write.text(path)

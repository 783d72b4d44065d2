"""Cut lineage by writing an intermediate table and reading it back.

Tables go to the shared folder that the cluster names in ``spark.checkpoint.dir``
(or to the context's checkpoint folder), so a lost executor costs a re-read and
not a re-run. There is no other place: without a folder an operator that needs
one fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


class Tables:
    """The intermediate tables of the operators called inside a ``with`` block.

    ``release`` deletes them, once no result that reads them is needed; tables of
    other blocks stay.
    """

    def __init__(self) -> None:
        self.paths: list[str] = []

    def __enter__(self) -> Tables:
        _open.append(self)
        return self

    def __exit__(self, *error: object) -> None:
        _open.remove(self)

    def release(self, spark: SparkSession) -> None:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        while self.paths:
            path = hadoop.Path(self.paths.pop())
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Open blocks, the innermost last; the first holds what is written outside of any.
_open = [Tables()]


def folder(spark: SparkSession) -> str:
    """The folder for intermediate tables of this session."""
    shared = spark.conf.get(SETTING, None)
    if not shared:
        context = spark.sparkContext._jsc.sc().getCheckpointDir()
        shared = context.get() if context.isDefined() else None
    if not shared:
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    return shared.rstrip("/")


def place(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, deleted with the tables of the open block."""
    path = f"{folder(spark)}/tessera-{name}-{uuid.uuid4().hex}"
    _open[-1].paths.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return the table."""
    path = place(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the tables written outside of any block."""
    _open[0].release(spark)

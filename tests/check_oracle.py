"""Compare every registered query with its SQL: python tests/check_oracle.py [sf_dir] [name...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    start = time.time()
    result = entry.queries()[name](spark, sf_dir)
    got = normal([tuple(r) for r in result.collect()], result.columns)
    spent = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return False, f"{spent:6.1f} s  {len(got)} rows, no SQL"
    start = time.time()
    expected = con.sql(sql)
    want = normal(expected.fetchall(), expected.columns)
    same = got == want and sorted(result.columns) == sorted(expected.columns)
    note = f"{spent:6.1f} s  {len(got)} rows, SQL {len(want)} rows in {time.time() - start:.1f} s"
    types = {c: str(t) for c, t in zip(expected.columns, expected.types)}
    for field in result.schema:
        note += f" {field.name}:{field.dataType.simpleString()}/{types.get(field.name)}" if not same else ""
    if not same:
        note += f"\n   only here {[r for r in got if r not in set(want)][:3]}\n   only SQL {[r for r in want if r not in set(got)][:3]}"
    return same, note


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.oracle_sql())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in names:
        try:
            same, note = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            same, note = False, repr(error)[:600]
        print("ok  " if same else "FAIL", name, note, flush=True)
        if not same:
            failed.append(name)
    print("failed:", failed)

"""Registered queries against DuckDB, on the smallest tables."""

import check_oracle
import pytest

entry = check_oracle.entry
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    same, note = check_oracle.compare(spark, con, SF, name)
    assert same, note


def test_every_sql_has_a_query():
    missing = set(entry.queries()) - set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # Only the operators for training data have queries beyond SQL.
    assert all(name == "pipeline" or name.startswith("op") for name in missing)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["src", "dst", "dist", "rk"] and result.count() > 0

"""Every query with SQL against DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tilewright.plans import catalogue

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables here")


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool) or not isinstance(value, (int, float)) and not hasattr(value, "as_tuple"):
        return str(value)
    return repr(round(float(value), 6))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), sorted(tuple(plain(row[k]) for k in order) for row in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows(spark, duck, name):
    found = catalogue.QUERIES[name](spark, str(SF))
    own = rows_of(found.columns, found.collect())
    cursor = duck.execute(catalogue.ORACLE_SQL[name])
    assert own == rows_of([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_same_draws_however_partitioned(spark, name):
    first = sorted(map(str, catalogue.QUERIES[name](spark, str(SF)).collect()))
    assert first
    again = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        assert name == "noise_stats" or sorted(map(str, catalogue.QUERIES[name](spark, str(SF)).collect())) == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", again)


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["label", "rank", "oy", "ox", "texture"]
    assert found.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

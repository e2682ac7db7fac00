"""The queries of the subpackage with SQL against DuckDB on the smallest tables, and all of them on the same."""

from pathlib import Path

import duckdb
import pytest

from tests.test_catalogue import rows_of
from tilewright.llm import queries

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows(spark, name):
    found = queries.QUERIES[name](spark, str(SF))
    own = rows_of(found.columns, found.collect())
    con = duckdb.connect()
    for path in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    cursor = con.execute(queries.ORACLE_SQL[name])
    assert own == rows_of([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_runs_over_the_whole_table(spark, name):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    found = queries.QUERIES[name](spark, str(SF))
    assert found.select("doc_id").distinct().count() == n or name == "op1_string_tiling"

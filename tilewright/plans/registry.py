"""How the query modules list what they have."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Listing:
    """Queries and their SQL, by the function's name."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def keep(query):
            self.queries[query.__name__] = query
            if sql:
                self.sql[query.__name__] = sql
            return query

        return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(column: Column) -> Column:
    """Six decimals: engines add in different orders."""
    return F.round(column, 6)

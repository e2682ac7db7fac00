"""Every query of the library by name, and its SQL.

The tables at hand stand in for sensor data: embeddings for 8 x 8 mosaics, events
for ledgers and metric series, documents for shards, orders and customers for
photos and film rolls, parts and suppliers for cameras.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tilewright.plans import bookkeeping, calibration, mosaics, series, stores, texts

_MODULES = (mosaics, texts, bookkeeping, calibration, series, stores)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _module in _MODULES:
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.ORACLE_SQL

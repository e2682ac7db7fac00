"""Time stamps as text. The moment is a parameter, so that a rerun gives the same."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _utc(moment: Column) -> Column:
    return F.to_utc_timestamp(moment, F.current_timezone())


def iso_seconds(moment: Column) -> Column:
    """2024-05-06T07:08:09+00:00"""
    return F.concat(F.date_format(_utc(moment), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def day(moment: Column) -> Column:
    """20240506"""
    return F.date_format(_utc(moment), "yyyyMMdd")


def stamp(moment: Column) -> Column:
    """20240506-070809"""
    return F.date_format(_utc(moment), "yyyyMMdd-HHmmss")


def local_day(moment: Column) -> Column:
    """2024-05-06, in the session's time zone."""
    return F.date_format(moment, "yyyy-MM-dd")

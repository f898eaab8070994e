"""Time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds(column: str | Column) -> Column:
    """Seconds since the epoch as DOUBLE, microseconds kept."""
    value = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(value.cast("timestamp")) / F.lit(1000000.0)


def hour_of_day(time_s: str = "time_s") -> Column:
    """Hour 0..23 of a count of seconds; floor semantics also below zero."""
    return F.pmod(F.floor(F.col(time_s) / 3600), F.lit(24)).cast("int")


def day_of_week(time_s: str = "time_s") -> Column:
    """Day 0..6 of a count of seconds; floor semantics also below zero."""
    return F.pmod(F.floor(F.col(time_s) / 86400), F.lit(7)).cast("int")


def year_month(date: str | Column) -> Column:
    """``yyyyMM`` text of a date."""
    return F.date_format(date, "yyyyMM")

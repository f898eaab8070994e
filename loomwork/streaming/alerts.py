"""Windowed counters and alert rules; each works on a table as on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.operators.ordered import exact_quantiles

WATERMARK = "1 hour"
WINDOW_S = 300


def _start(window: str = "window") -> Column:
    return F.unix_timestamp(F.col(f"{window}.start")).alias("window_start")


def event_counters(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Events per window and kind; ``window_start`` in epoch seconds."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", WATERMARK)
    return timed.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n")).select(_start(), "event_type", "n")


def latency_windows(events: DataFrame, accuracy: int = 10000) -> DataFrame:
    """95th percentile per five-minute window of a stream (mergeable sketch, bounded state)."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", WATERMARK)
    p95 = F.percentile_approx("value", 0.95, accuracy)
    return timed.groupBy(F.window("ts", f"{WINDOW_S} seconds")).agg(p95.alias("p95")).select(_start(), "p95")


def latency_windows_exact(events: DataFrame) -> DataFrame:
    """The same over a table, exact and interpolated; a busy window is not gathered in one task."""
    bucket = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / WINDOW_S) * WINDOW_S
    rows = events.select(bucket.alias("window_start"), "value")
    return exact_quantiles(rows, "value", [0.95], by=["window_start"]).select("window_start", F.col("value").alias("p95"))


def held_alerts(windows: DataFrame, limit: float) -> DataFrame:
    """A window alerts when it and the window right before it are over the limit.

    The window before is looked up by its start, so windows need no common order.
    """
    over = windows.select("window_start", "p95", (F.col("p95") > limit).alias("over"))
    before = over.filter("over").select((F.col("window_start") + WINDOW_S).alias("window_start"), F.lit(True).alias("before"))
    joined = over.join(before, "window_start", "left")
    return joined.select("window_start", "p95", "over", (F.col("over") & F.coalesce("before", F.lit(False))).alias("alert"))


def newest_event(events: DataFrame) -> DataFrame:
    """Newest event time in epoch seconds: one row, as table or stream."""
    return events.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1000000.0)).alias("newest"))


def freshness(newest: DataFrame, as_of_s: float, limit_hours: float = 36) -> DataFrame:
    """Age in hours at a stated time and whether it is over the limit."""
    age = (F.lit(float(as_of_s)) - F.col("newest")) / 3600
    return newest.select(age.alias("age_hours"), (age > limit_hours).alias("stale"))

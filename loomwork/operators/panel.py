"""Reshaping and aligning long panels ``(date, asset, value)``.

A panel has one row per (date, asset), so the rows of one asset are bounded by the calendar and the rows of
one date by the asset list. Windows below partition by asset or by date only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.functions.text import strip


def calendar_of(panel: DataFrame) -> DataFrame:
    """Distinct dates."""
    return panel.select("date").distinct()


def spine(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every (date, asset) of a calendar and the panel's assets.

    The dates travel as one array (one DATE per calendar day), unrolled next to each asset.
    """
    days = calendar.agg(F.collect_set("date")).scalar()
    return panel.select("asset").distinct().select("asset", F.explode(days).alias("date"))


def _filled(panel: DataFrame, calendar: DataFrame, value: str) -> DataFrame:
    """Value as of each calendar date. Spine and data meet in one window, so there is one shuffle, on asset."""
    slots = spine(panel, calendar).select("date", "asset", F.lit(None).cast("double").alias(value), F.lit(1).alias("slot"))
    both = panel.select("date", "asset", F.col(value).cast("double").alias(value), F.lit(0).alias("slot")).unionByName(slots)
    past = W.partitionBy("asset").orderBy("date", "slot").rowsBetween(W.unboundedPreceding, 0)
    return both.withColumn(value, F.last(value, ignorenulls=True).over(past)).filter("slot = 1").drop("slot")


def dense_panel(panel: DataFrame, value: str = "close") -> DataFrame:
    """Panel on its own full calendar, gaps forward-filled; null before an asset's first value."""
    return _filled(panel, calendar_of(panel), value)


def asof_align(panel: DataFrame, calendar: DataFrame, value: str = "close") -> DataFrame:
    """Panel on another calendar: last earlier value, else the first later one."""
    filled = _filled(panel, calendar, value)
    later = W.partitionBy("asset").orderBy("date").rowsBetween(0, W.unboundedFollowing)
    return filled.withColumn(value, F.first(value, ignorenulls=True).over(later))


def on_calendar(panel: DataFrame, calendar: DataFrame, value: str = "close") -> DataFrame:
    """Reindex first, then fill: only values dated on the calendar count; leading gaps take the first one."""
    return asof_align(panel.join(calendar.select("date"), "date", "left_semi"), calendar, value)


def reindex_fill_zero(weights: DataFrame, grid: DataFrame, value: str = "w") -> DataFrame:
    """Weights on a (date, asset) grid; missing cells are zero."""
    return grid.select("date", "asset").join(weights, ["date", "asset"], "left").withColumn(
        value, F.coalesce(F.col(value), F.lit(0.0))
    )


def hold_weights_from(latest: DataFrame, calendar: DataFrame, start: Column) -> DataFrame:
    """Constant weights from a date on, zero before it."""
    days = calendar.agg(F.collect_set("date")).scalar()
    return latest.select("asset", "w", F.explode(days).alias("date")).select(
        "date", "asset", F.when(F.col("date") >= start, F.col("w")).otherwise(F.lit(0.0)).alias("w")
    )


def close_panel(bars: DataFrame, tickers: Sequence[str], start: str, end: str) -> DataFrame:
    """Wide closes of chosen tickers between two dates; the filters reach the scan."""
    picked = bars.filter(F.col("asset").isin(*tickers) & F.col("date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    return long_to_wide(picked, tickers)


def long_to_wide(panel: DataFrame, assets: Sequence[str], value: str = "close") -> DataFrame:
    """One column per named asset; the names are given, so no extra pass looks for them."""
    return panel.groupBy("date").pivot("asset", list(assets)).agg(F.first(value))


def wide_to_long(wide: DataFrame, value: str = "close") -> DataFrame:
    """Back to (date, asset, value), missing cells dropped."""
    names = [c for c in wide.columns if c != "date"]
    return wide.unpivot(["date"], names, "asset", value).dropna(subset=[value])


def available_tickers(bars: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Distinct assets, optionally within dates."""
    if start:
        bars = bars.filter(F.col("date") >= F.to_date(F.lit(start)))
    if end:
        bars = bars.filter(F.col("date") <= F.to_date(F.lit(end)))
    return bars.select("asset").distinct()


def date_range(bars: DataFrame, ticker: str | None = None) -> DataFrame:
    """First and last date per asset; a ticker without rows is an error."""
    if ticker is not None:
        bars = bars.filter(F.col("asset") == ticker)
    spans = bars.groupBy("asset").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    if ticker is not None and spans.isEmpty():
        raise ValueError(f"no rows for {ticker}")
    return spans


def keep_last(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Last row per key. An aggregate, so copies of a hot key are reduced before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def union_dedupe_last(slices: Sequence[DataFrame], keys: Sequence[str] = ("date", "asset")) -> DataFrame:
    """Concatenate slices; on equal keys the later slice wins."""
    out = None
    for number, part in enumerate(slices):
        part = part.withColumn("_slice", F.lit(number))
        out = part if out is None else out.unionByName(part)
    return keep_last(out, keys, ["_slice"]).drop("_slice")


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str] = ("date", "asset")) -> DataFrame:
    """Incoming rows replace current rows of the same key."""
    return union_dedupe_last([current, incoming], keys)


def latest_cross_section(panel: DataFrame) -> DataFrame:
    """Rows of the newest date; the date is a scalar subquery, so nothing is joined."""
    return panel.filter(F.col("date") == panel.agg(F.max("date")).scalar())


def tail_rows(panel: DataFrame, n: int) -> DataFrame:
    """Rows of the last ``n`` dates."""
    newest = panel.select("date").distinct().orderBy(F.desc("date")).limit(n)
    return panel.filter(F.col("date") >= newest.agg(F.min("date")).scalar())


def alphas_for_tickers(panel: DataFrame, wanted: DataFrame, value: str = "alpha") -> DataFrame:
    """Newest non-missing values of the wanted assets."""
    return latest_cross_section(panel).join(wanted.select("asset"), "asset", "left_semi").dropna(subset=[value])


def ragged_to_panel(arrays: DataFrame) -> DataFrame:
    """``(asset, prices ARRAY)`` of unequal length → ``(step, asset, close)`` forward- then back-filled.

    Each array is padded with nulls to the longest length (a scalar) and unrolled; the fill is one window per asset.
    """
    longest = arrays.agg(F.max(F.size("prices"))).scalar()
    padding = F.array_repeat(F.lit(None).cast("double"), longest - F.size("prices"))
    rows = arrays.select("asset", F.posexplode(F.concat("prices", padding)).alias("step", "close"))
    past = W.partitionBy("asset").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    later = W.partitionBy("asset").orderBy("step").rowsBetween(0, W.unboundedFollowing)
    forward = rows.withColumn("close", F.last("close", ignorenulls=True).over(past))
    return forward.select("step", "asset", F.first("close", ignorenulls=True).over(later).alias("close"))


def canonical_ticker(rows: DataFrame, column: str = "asset") -> DataFrame:
    """Trim (any white space) and upper-case."""
    return rows.withColumn(column, F.upper(strip(column)))


def align_to_feature_list(rows: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Columns in the trained order, missing ones and nulls as 0, plus a flag when the order or set differs."""
    present = [c for c in rows.columns if c not in keys]
    picked = [
        (F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in present else F.lit(0.0)).alias(f) for f in features
    ]
    return rows.select(*keys, *picked, F.lit(present != list(features)).alias("feature_skew"))


def panel_profile(panel: DataFrame) -> DataFrame:
    """Shape, calendar ends and the three first and last dates (of the distinct calendar)."""
    days = panel.groupBy("date").agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list("date"))
    assets = panel.agg(F.count_distinct("asset")).scalar()
    return days.agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_dates"), F.min("date").alias("start"),
        F.max("date").alias("end"), F.array_join(F.slice(ordered, 1, 3), ",").alias("head_dates"),
        F.array_join(F.slice(F.reverse(ordered), 1, 3), ",").alias("tail_dates"),
    ).withColumn("n_assets", assets)


def panel_density(panel: DataFrame, low: float = 0.5, high: float = 1.0) -> DataFrame:
    """Distinct dates per calendar day, and whether that is within bounds."""
    row = panel.agg(F.count_distinct("date").alias("n_dates"), (F.datediff(F.max("date"), F.min("date")) + 1).alias("span_days"))
    density = F.col("n_dates") / F.col("span_days")
    return row.select("n_dates", "span_days", density.alias("density"), density.between(low, high).alias("within_bounds"))


def panel_freshness(rows: DataFrame, time: Column, as_of_s: float, limit_hours: float = 36) -> DataFrame:
    """Age of the newest row in hours at a stated time; ``time`` and ``as_of_s`` are epoch seconds."""
    age = (F.lit(float(as_of_s)) - F.max(time)) / 3600
    return rows.agg(age.alias("age_hours"), (age > limit_hours).alias("stale"))


def partition_coherence(panel: DataFrame) -> DataFrame:
    """Months present against the months between the first and the last date."""
    months = panel.groupBy(F.date_format("date", "yyyyMM").alias("ym")).agg(F.count("*").alias("n_rows"))
    span = panel.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    wanted = span.select(
        F.explode(F.sequence(F.trunc("a", "MM"), F.trunc("b", "MM"), F.expr("interval 1 month"))).alias("m")
    ).select(F.date_format("m", "yyyyMM").alias("ym"), F.lit(True).alias("expected"))
    return months.join(wanted, "ym", "full_outer").select(
        "ym", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.col("n_rows").isNotNull().alias("present"),
        F.coalesce("expected", F.lit(False)).alias("expected"),
    )


def month_cutoffs(panel: DataFrame) -> DataFrame:
    """Distinct month starts of the calendar."""
    return panel.select(F.trunc("date", "MM").alias("month_start")).distinct()

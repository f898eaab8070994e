"""Descriptive tables: balance, missing cells, moments, histograms, densities, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.clock import hour_of_day
from loomwork.operators.ordered import exact_quantiles
from loomwork.session import sized


def class_balance(df: DataFrame, label: str = "class") -> DataFrame:
    """Rows per class and their share."""
    total = df.agg(F.count("*")).scalar()
    return df.groupBy(label).agg(F.count("*").alias("n")).withColumn("share", F.col("n") / total)


def null_count(df: DataFrame) -> DataFrame:
    """Missing cells per column and in total, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    total = None
    for c in df.columns:
        total = F.col(c) if total is None else total + F.col(c)
    return counts.withColumn("total", total)


def describe_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, minimum, quartiles and maximum per column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    marks = exact_quantiles(long, "value", (0.25, 0.5, 0.75), by=["column"])
    quartiles = marks.groupBy("column").agg(*[
        F.max(F.when(F.col("q") == q, F.col("value"))).alias(name) for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
    ])
    return moments.join(quartiles, "column", "left")


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0…bins−1; the maximum falls in the last one; a single value in the middle."""
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low)
    return F.least(F.floor((value - start) / width * bins), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, column: str, bins: int, weight: str | None = None) -> DataFrame:
    """Counts per equal-width bin over the whole column; empty bins are not stored."""
    known = df.select(F.col(column).cast("double").alias("x"), (F.col(weight) if weight else F.lit(1)).alias("n")).dropna()
    ends = known.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    place = _bin(F.col("x"), F.col("_e.lo"), F.col("_e.hi"), bins)
    return known.withColumn("_e", ends).groupBy(place.alias("bin")).agg(F.sum("n").alias("n"))


def hist_by_class(df: DataFrame, column: str = "amount", label: str = "class", bins: int = 50) -> DataFrame:
    """The same per class, each class over its own range."""
    ends = df.groupBy(label).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    placed = df.select(label, column).dropna().join(sized(ends), label)
    return placed.groupBy(label, _bin(F.col(column), F.col("lo"), F.col("hi"), bins).alias("bin")).agg(F.count("*").alias("n"))


def hour_hist_by_class(df: DataFrame, label: str = "class") -> DataFrame:
    return df.groupBy(label, hour_of_day().alias("hour")).agg(F.count("*").alias("n"))


REACH = 9.0  # bandwidths around a value that receive its kernel; beyond, a term is below exp(-40.5) of its peak


def kde_by_class(df: DataFrame, column: str, label: str = "class", points: int = 1000, reach: float = REACH) -> DataFrame:
    """Gaussian density per class on an even grid reaching half the range beyond both ends: (label, point, grid_x, density).

    Bandwidth: sample deviation × n^(−1/5). See ``kde_by_class_columns``.
    """
    return kde_by_class_columns(df, [column], label, points, reach).drop("column")


def kde_by_class_columns(df: DataFrame, columns: Sequence[str], label: str = "class", points: int = 1000, reach: float = REACH) -> DataFrame:
    """Densities of several columns in one pass: (column, label, point, grid_x, density).

    Equal values are counted first. Each distinct value adds its kernel only to the grid points within ``reach``
    bandwidths of it (a range of point numbers computed from the value), so the work is values × points in reach, not
    values × all points; the sums are taken map-side per (column, class, point). Grid points that no value reaches are
    filled in with density 0. Classes with fewer than two values or no spread have no grid.
    """
    long = df.select(label, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])).alias("_v"))
    long = long.select(label, "_v.column", "_v.x").dropna(subset=["x"])
    stats = long.groupBy("column", label).agg(
        F.count("x").alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi")
    ).select("column", label, "n", (F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("h"), "lo", (F.col("hi") - F.col("lo")).alias("range"))
    stats = sized(stats.filter("n > 1 and h > 0"))
    step = F.col("range") * (2.0 / (points - 1))
    start = F.col("lo") - F.col("range") * 0.5
    values = long.groupBy("column", label, "x").agg(F.count("*").alias("c")).join(stats, ["column", label])
    first = F.greatest(F.ceil((F.col("x") - reach * F.col("h") - start) / step), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("x") + reach * F.col("h") - start) / step), F.lit(points - 1)).cast("int")
    near = values.where(first <= last).select("column", label, "x", "c", "h", "lo", "range", F.explode(F.sequence(first, last)).alias("point"))
    at = start + F.col("point") * step
    z = (at - F.col("x")) / F.col("h")
    sums = near.groupBy("column", label, "point").agg(F.sum(F.col("c") * F.exp(z * z * -0.5)).alias("s"))
    grid = stats.select("column", label, "n", "h", "lo", "range", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    norm = 1.0 / (2.0 * 3.141592653589793) ** 0.5
    return grid.join(sums, ["column", label, "point"], "left").select(
        "column", label, "point", (start + F.col("point") * step).alias("grid_x"),
        (F.coalesce(F.col("s"), F.lit(0.0)) * norm / (F.col("n") * F.col("h"))).alias("density"))


def corr_with_label(df: DataFrame, columns: Sequence[str], label: str = "class") -> DataFrame:
    """Pearson correlation of each column with the label; one aggregate pass."""
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c) for c in columns])
    return row.unpivot([], list(columns), "column", "corr")

"""Run metrics as long tables ``(metric, value)``, limits per profile, and comparisons between runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Per profile, the bound of each metric and the side it bounds.
LIMITS = {
    "dev": {
        "sharpe_annual": ("min", -5.0), "vol_annual": ("max", 1.0), "max_dd": ("max", 0.50),
        "turnover_pct_day": ("max", 0.30), "hit_ratio": ("min", 0.30), "max_beta": ("max", 0.01),
        "max_sector_l2": ("max", 0.005), "pass_rate": ("min", 0.90), "infeasible_ratio": ("max", 0.01),
        "score_p95_ms": ("max", 1000.0), "explain_p95_ms": ("max", 2000.0), "freshness_hours": ("max", 72.0),
    },
    "staging": {
        "sharpe_annual": ("min", -1.0), "vol_annual": ("max", 0.75), "max_dd": ("max", 0.35),
        "turnover_pct_day": ("max", 0.20), "hit_ratio": ("min", 0.35), "max_beta": ("max", 0.005),
        "max_sector_l2": ("max", 0.002), "pass_rate": ("min", 0.95), "infeasible_ratio": ("max", 0.005),
        "score_p95_ms": ("max", 500.0), "explain_p95_ms": ("max", 1000.0), "freshness_hours": ("max", 48.0),
    },
    "prod": {
        "sharpe_annual": ("min", -0.10), "vol_annual": ("max", 0.50), "max_dd": ("max", 0.20),
        "turnover_pct_day": ("max", 0.15), "hit_ratio": ("min", 0.45), "max_beta": ("max", 0.001),
        "max_sector_l2": ("max", 0.0005), "pass_rate": ("min", 0.99), "infeasible_ratio": ("max", 0.001),
        "score_p95_ms": ("max", 200.0), "explain_p95_ms": ("max", 400.0), "freshness_hours": ("max", 36.0),
    },
}


def limits_table(spark: SparkSession, limits: dict = LIMITS) -> DataFrame:
    """``(profile, metric, op, bound)``."""
    rows = [(p, m, op, float(v)) for p, items in limits.items() for m, (op, v) in items.items()]
    return spark.createDataFrame(rows, "profile string, metric string, op string, bound double")


def to_metrics(row: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Numeric columns of a summary as ``(keys…, metric, value)``."""
    names = [f.name for f in row.schema.fields if f.name not in keys and isinstance(f.dataType, T.NumericType)]
    cast = row.select(*keys, *[F.col(n).cast("double").alias(n) for n in names])
    return cast.unpivot(list(keys), names, "metric", "value")


def flatten_metrics_json(rows: DataFrame, column: str, metrics: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """A JSON text per row as ``(keys…, metric, value)``; absent or non-numeric metrics are left out.

    ``metrics`` are dotted paths; the text is parsed once per row.
    """
    variant = rows.select(*keys, F.try_parse_json(column).alias("_doc"))
    items = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.try_variant_get("_doc", f"$.{m}", "double").alias("value")) for m in metrics
    ])
    return variant.select(*keys, F.inline(items)).dropna(subset=["value"])


def checked_limits(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """Each limit with the metric's value; drawdowns count by size; a metric nobody reported is marked missing."""
    value = F.when(F.col("metric") == "max_dd", F.abs("value")).otherwise(F.col("value"))
    joined = limits.join(metrics, "metric", "left").withColumn("value", value)
    broken = F.when(F.col("op") == "min", F.col("value") < F.col("bound")).otherwise(F.col("value") > F.col("bound"))
    return joined.select(
        "profile", "metric", "op", "bound", "value", F.coalesce(broken, F.lit(False)).alias("violated"),
        F.col("value").isNull().alias("missing"),
    )


def threshold_gate(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """Per profile: PASSED or FAILED, the violations and the missing metrics."""

    def names(flag):
        return F.array_join(F.array_sort(F.collect_list(F.when(F.col(flag), F.col("metric")))), ",")

    return checked_limits(metrics, limits).groupBy("profile").agg(
        F.when(F.bool_or("violated"), F.lit("FAILED")).otherwise(F.lit("PASSED")).alias("status"),
        names("violated").alias("violations"), names("missing").alias("missing"), F.count("*").alias("n_limits"),
    )


def metric_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Metrics whose value differs between two runs, or which only one run has."""
    a = old.select("metric", F.col("value").alias("old_value"))
    b = new.select("metric", F.col("value").alias("new_value"))
    return a.join(b, "metric", "full_outer").filter(~F.col("old_value").eqNullSafe(F.col("new_value")))


def missing_required_metrics(metrics: DataFrame, required: DataFrame) -> DataFrame:
    """Required names that are not reported with a value."""
    return required.join(metrics.dropna(subset=["value"]), "metric", "left_anti")


def metric_summary(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, sample deviation, smallest and largest value per column, one row each."""
    long = rows.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "metric", "value")
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )

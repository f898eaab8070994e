"""Transaction features: ``(id, time_s, amount, v1…, user_id, class)`` in, columns added."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.clock import day_of_week, hour_of_day
from loomwork.operators.ordered import trailing_sums

HOUR_S = 3600.0

# The products of feature columns.
PRODUCTS = [("v1", "v2"), ("v3", "v4"), ("v1", "v3")]

MODEL_FEATURES = ["time_s", "v1", "v2", "v3", "v4", "amount", "amount_log", "hour", "day", "v1_v2", "v3_v4", "v1_v3", "amount_z_hour"]


def amount_log(txn: DataFrame) -> DataFrame:
    """log(1 + amount), negative amounts as 0."""
    return txn.withColumn("amount_log", F.log1p(F.greatest(F.col("amount"), F.lit(0.0))))


def time_features(txn: DataFrame) -> DataFrame:
    """Hour of day and day of week from seconds."""
    return txn.withColumns({"hour": hour_of_day(), "day": day_of_week()})


def interactions(txn: DataFrame) -> DataFrame:
    return txn.withColumns({f"{a}_{b}": F.col(a) * F.col(b) for a, b in PRODUCTS})


def hour_stats(txn: DataFrame) -> DataFrame:
    """Mean and sample deviation of the amount per hour (24 rows); a deviation of 0 counts as 1."""
    hourly = txn.groupBy(hour_of_day().alias("hour")) if "hour" not in txn.columns else txn.groupBy("hour")
    sd = F.stddev_samp("amount")
    return hourly.agg(F.avg("amount").alias("amount_mean"), F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias("amount_std"))


def hour_stats_join(txn: DataFrame, stats: DataFrame) -> DataFrame:
    """Deviation of each amount from its hour's mean, in hourly deviations.

    The hour is taken modulo 24, so the broadcast side has at most 24 rows; busy hours are not shuffled.
    """
    with_hour = txn if "hour" in txn.columns else txn.withColumn("hour", hour_of_day())
    z = (F.col("amount") - F.col("amount_mean")) / F.col("amount_std")
    return with_hour.join(F.broadcast(stats), "hour", "left").withColumn("amount_z_hour", z).drop("amount_mean", "amount_std")


def amount_z_by_hour(txn: DataFrame) -> DataFrame:
    """As above with statistics of the same rows."""
    return hour_stats_join(txn, hour_stats(txn))


def velocity_1h(txn: DataFrame) -> DataFrame:
    """Count and spend of the rows of the hour before each row, over all users."""
    summed = trailing_sums(txn, "time_s", "id", "amount", HOUR_S)
    return summed.withColumnsRenamed({"trailing_count": "velocity_count_1h", "trailing_sum": "velocity_amount_1h"})


def velocity_1h_by_user(txn: DataFrame) -> DataFrame:
    """The same per user."""
    summed = trailing_sums(txn, "time_s", "id", "amount", HOUR_S, by=["user_id"])
    return summed.withColumnsRenamed({"trailing_count": "velocity_count_1h", "trailing_sum": "velocity_amount_1h"})


def engineer_features(txn: DataFrame) -> DataFrame:
    """All of the above."""
    return velocity_1h(txn).transform(amount_log).transform(time_features).transform(interactions).transform(amount_z_by_hour)


def serving_features(txn: DataFrame, stats: DataFrame) -> DataFrame:
    """Model features with stored hour statistics and without velocity, as a stream can compute them.

    An hour without statistics gives a deviation of 0.
    """
    base = txn.transform(amount_log).transform(time_features).transform(interactions)
    return hour_stats_join(base, stats).withColumn("amount_z_hour", F.coalesce("amount_z_hour", F.lit(0.0)))


def score_decision(scored: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """Verdict at a threshold, probability to four digits."""
    return scored.withColumns({
        "fraud_probability": F.round(score, 4),
        "prediction": F.when(F.col(score) >= threshold, F.lit("fraud")).otherwise(F.lit("legitimate")),
        "threshold": F.lit(float(threshold)),
    })


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x − mean) / population deviation; a constant column keeps divisor 1. One pass for all columns."""
    row = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns])
    found = df.withColumn("_fit", row.select(F.struct(*columns)).scalar())

    def scaled(c: str) -> Column:
        sd = F.col(f"_fit.{c}.s")
        return (F.col(c) - F.col(f"_fit.{c}.m")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)

    return found.withColumns({c: scaled(c) for c in columns}).drop("_fit")

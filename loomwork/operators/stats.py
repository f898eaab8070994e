"""Statistical validity of a return series ``(date, ret)``; one row per calendar day."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.operators.backtest import YEAR


def newey_west_sharpe_ci(series: DataFrame, z: float = 1.96, lags: int = 4) -> DataFrame:
    """Yearly Sharpe with a confidence band from Bartlett-weighted autocovariances (at most ``lags``, n/4)."""
    day = W.orderBy("date")
    shifted = series.select("ret", *[F.lag("ret", k).over(day).alias(f"lag_{k}") for k in range(1, lags + 1)])
    row = shifted.agg(
        F.count("ret").alias("n"), F.avg("ret").alias("mean"), F.stddev_samp("ret").alias("sd"), F.var_pop("ret").alias("g0"),
        *[F.covar_samp("ret", f"lag_{k}").alias(f"g{k}") for k in range(1, lags + 1)],
    )
    used = F.least(F.lit(lags), F.floor(F.col("n") / 4))
    variance = F.col("g0")
    for k in range(1, lags + 1):
        part = 2 * (1 - F.lit(k) / (used + 1)) * F.col(f"g{k}")
        variance = variance + F.when(F.lit(k) <= used, F.coalesce(part, F.lit(0.0))).otherwise(F.lit(0.0))
    sharpe = F.col("mean") / F.col("sd") * math.sqrt(YEAR)
    margin = z * F.sqrt(F.when(variance >= 0, variance) / F.col("n")) / F.col("sd") * math.sqrt(YEAR)
    usable = (F.col("n") >= 2) & (F.col("sd") > 0)
    return row.select(
        *[F.when(usable, v).otherwise(F.lit(0.0)).alias(name)
          for name, v in (("sharpe", sharpe), ("lower", sharpe - margin), ("upper", sharpe + margin))]
    )


def chunked_sharpe_pbo(series: DataFrame, chunks: int = 10, least: int = 20) -> DataFrame:
    """Spread of the Sharpe ratio over equal consecutive chunks, as a share of its mean, at most 1."""
    total = series.agg(F.count("*")).scalar()
    placed = series.select("ret", (F.row_number().over(W.orderBy("date")) - 1).alias("i"), total.alias("n"))
    size = F.greatest(F.lit(least), F.floor(F.col("n") / chunks))
    grouped = placed.filter("n >= 50").withColumn("chunk", F.floor(F.col("i") / size)).filter(F.col("chunk") < F.floor(F.col("n") / size))
    each = grouped.groupBy("chunk").agg(F.avg("ret").alias("m"), F.stddev_samp("ret").alias("s")).filter("s > 0")
    ratios = each.select((F.col("m") / F.col("s") * math.sqrt(YEAR)).alias("sharpe"))
    mean, spread = F.avg("sharpe"), F.stddev_pop("sharpe")
    cv = F.when((F.count("sharpe") < 2) | (F.abs(mean) < 1e-6), F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.try_divide(spread, F.abs(mean))))
    return ratios.agg(F.coalesce(cv, F.lit(0.0)).alias("pbo"), F.count("sharpe").alias("n_chunks"))


def block_bootstrap_sharpe(series: DataFrame, replicas: int = 10000, block: int = 20, confidence: float = 0.95) -> DataFrame:
    """Percentile band of the Sharpe ratio over series rebuilt from consecutive blocks.

    Running sums of the series (one pair per calendar day) travel as one array; each drawn block then costs two
    look-ups, and a replica needs the sums of its blocks only. Block starts come from the digits of an md5 of
    replica and slot, so replicas are independent draws and repeat anywhere.
    """
    past = W.orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    cum = series.select(
        F.row_number().over(W.orderBy("date")).alias("i"), F.sum("ret").over(past).alias("s"),
        F.sum(F.col("ret") * F.col("ret")).over(past).alias("q"),
    )
    zero = F.array(F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q")))
    sums = cum.agg(F.concat(zero, F.array_sort(F.collect_list(F.struct("i", "s", "q")))).alias("c"))
    spark = series.sparkSession
    n = F.size("c") - 1
    slots = spark.range(replicas).select(F.col("id").alias("replica"), sums.scalar().alias("c")).filter(n >= block).select(
        "replica", "c", n.alias("n"), F.explode(F.sequence(F.lit(0), F.ceil(n / block).cast("int") - 1)).alias("slot")
    )
    drawn = slots.withColumn(
        "start", (F.conv(F.substring(F.md5(F.concat_ws(",", F.col("replica"), F.col("slot")).cast("binary")), 1, 12), 16, 10).cast("bigint") % (F.col("n") - block + 1)).cast("int")
    ).withColumn("stop", F.col("start") + F.least(F.lit(block), F.col("n") - F.col("slot") * block))
    ends = drawn.select("replica", "n", F.get("c", F.col("start")).alias("a"), F.get("c", F.col("stop")).alias("b"))
    each = ends.groupBy("replica", "n").agg(
        F.sum(F.col("b.s") - F.col("a.s")).alias("s"), F.sum(F.col("b.q") - F.col("a.q")).alias("q")
    )
    mean = F.col("s") / F.col("n")
    sd = F.sqrt(F.greatest(F.lit(0.0), (F.col("q") - F.col("s") * mean) / (F.col("n") - 1)))
    ratios = each.select((mean / F.when(sd > 0, sd) * math.sqrt(YEAR)).alias("sharpe"))
    tail = (1 - confidence) / 2
    return ratios.agg(
        F.coalesce(F.percentile("sharpe", F.lit(tail)), F.lit(0.0)).alias("lower"),
        F.coalesce(F.percentile("sharpe", F.lit(1 - tail)), F.lit(0.0)).alias("upper"),
        F.count("sharpe").alias("replicas"),
    )

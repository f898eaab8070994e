"""Daily backtest and the statistics of its return series.

A series has one row per date (and per key in ``by``), so windows over it are bounded by the calendar.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.operators.features import by_asset, safe_return
from loomwork.operators.portfolio import hashed_sector, rolling_beta

YEAR = 252  # trading days


def book(dense: DataFrame, weights: DataFrame) -> DataFrame:
    """Weights on the price calendar (gaps 0) with the day's return: ``(date, asset, ret, w)``."""
    grid = dense.select("date", "asset", safe_return(1).alias("ret"))
    return grid.join(weights.select("date", "asset", "w"), ["date", "asset"], "left").withColumn("w", F.coalesce("w", F.lit(0.0)))


def _with_previous(held: DataFrame) -> DataFrame:
    return held.withColumn("prev_w", F.lag("w", 1).over(by_asset()))


GROSS_RET = "sum(coalesce(prev_w, 0D) * ret)"
TURNOVER = "coalesce(sum(abs(w - prev_w)), 0D)"


def lagged_portfolio_return(held: DataFrame) -> DataFrame:
    """Yesterday's weights times today's returns, summed per date."""
    return _with_previous(held).groupBy("date").agg(F.expr(GROSS_RET).alias("gross_ret"))


def turnover_cost(held: DataFrame, spread_bps: float = 5.0) -> DataFrame:
    """Sum of absolute weight changes times the spread; the first day has none."""
    return _with_previous(held).groupBy("date").agg((F.expr(TURNOVER) * (spread_bps / 10000)).alias("cost"))


def strategy_returns(held: DataFrame, spread_bps: float = 5.0) -> DataFrame:
    """Portfolio return less turnover cost; both sums in one aggregate."""
    return _with_previous(held).groupBy("date").agg(
        (F.expr(GROSS_RET) - F.expr(TURNOVER) * (spread_bps / 10000)).alias("ret")
    )


def _running(by: Sequence[str]):
    return W.partitionBy(*by).orderBy("date").rowsBetween(W.unboundedPreceding, 0)


def growth(by: Sequence[str] = ()) -> Column:
    """Running product of 1 + return, missing returns as 0."""
    return F.product(1 + F.coalesce("ret", F.lit(0.0))).over(_running(by))


def cumulative_pnl(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return series.select(*by, "date", growth(by).alias("cum"))


def backtest_summary(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sharpe (population deviation), yearly growth over at least one year, worst fall from a running high."""
    cum = series.select(*by, "date", "ret", growth(by).alias("cum"))
    fall = cum.withColumn("dd", F.col("cum") / F.max("cum").over(_running(by)) - 1)
    sigma = F.stddev_pop("ret") * math.sqrt(YEAR)
    years = F.greatest(F.lit(1.0), F.count("*") / float(YEAR))
    return fall.groupBy(*by).agg(
        F.when(sigma == 0, F.lit(0.0)).otherwise(F.try_divide(F.avg("ret") * float(YEAR), sigma)).alias("sharpe"),
        (F.pow(F.max_by("cum", "date"), F.lit(1.0) / years) - 1).alias("cagr"),
        F.min("dd").alias("max_drawdown"),
    )


def rolling_sharpe(series: DataFrame, rows: int = 60, by: Sequence[str] = ()) -> DataFrame:
    """Mean over deviation of the trailing rows, per year; null until the window is full."""
    frame = W.partitionBy(*by).orderBy("date").rowsBetween(-(rows - 1), 0)
    ratio = F.avg("ret").over(frame) / (F.stddev_samp("ret").over(frame) + 1e-12) * math.sqrt(YEAR)
    return series.select(*by, "date", F.when(F.count("ret").over(frame) == rows, ratio).alias("sharpe_60"))


def arith_drawdown_metrics(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Summary on summed rather than compounded returns."""
    total = series.select(*by, "date", "ret", F.sum("ret").over(_running(by)).alias("cum"))
    fall = total.withColumn("dd", F.col("cum") - F.max("cum").over(_running(by)))
    spread = F.stddev_samp("ret")
    return fall.groupBy(*by).agg(
        F.coalesce(F.try_divide(F.avg("ret") * float(YEAR), spread * math.sqrt(YEAR)), F.lit(0.0)).alias("sharpe_annual"),
        (spread * math.sqrt(YEAR)).alias("vol_annual"),
        (F.pow(1 + F.avg("ret"), F.lit(float(YEAR))) - 1).alias("cagr"),
        F.min("dd").alias("max_dd"),
        F.avg((F.col("ret") > 0).cast("double")).alias("hit_ratio"),
    )


def realised_metrics(weights: DataFrame, series: DataFrame) -> DataFrame:
    """Daily one-way turnover, mean gross exposure, share of winning days, weights per day that moved by more than 1e-12."""
    moved = weights.withColumn("prev_w", F.lag("w", 1).over(by_asset()))
    change = F.col("w") - F.col("prev_w")
    daily = moved.groupBy("date").agg(
        (F.sum(F.abs(change)) / 2).alias("turnover"), F.sum(F.abs("w")).alias("gross"),
        F.count_if(F.abs(change) > 1e-12).alias("trades"), F.count("prev_w").alias("known"),
    )
    hits = series.agg(F.avg((F.col("ret") > 0).cast("double"))).scalar()
    later = F.col("known") > 0  # every day but the first has a previous weight
    return daily.agg(
        F.coalesce(F.avg(F.when(later, F.col("turnover"))), F.lit(0.0)).alias("turnover_pct_day"),
        F.avg("gross").alias("avg_gross"),
        F.coalesce(F.avg(F.when(later, F.col("trades"))), F.lit(0.0)).alias("trades_per_day"),
    ).withColumn("hit_ratio", hits)


def daily_diagnostics(held: DataFrame, spread_bps: float = 5.0, rows: int = 60) -> DataFrame:
    """Per day: return, net weight, market beta on the trailing rows and the length of the sector vector.

    Weights are made per date, so the market mean is taken there too; betas and previous weights then share the
    window of each asset, and sums per (date, sector) are summed per date.
    """
    market = held.withColumn("mkt", F.avg("ret").over(W.partitionBy("date")))
    full = _with_previous(rolling_beta(market, rows))
    per_sector = full.groupBy("date", hashed_sector().alias("sector")).agg(
        F.sum("w").alias("w"), F.sum(F.col("w") * F.col("beta")).alias("wb"), F.expr(GROSS_RET).alias("gross"), F.expr(TURNOVER).alias("turnover")
    )
    return per_sector.groupBy("date").agg(
        (F.sum("gross") - F.sum("turnover") * (spread_bps / 10000)).alias("ret"), F.sum("w").alias("net"), F.sum("wb").alias("beta"),
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("sector_l2"),
    )


def constraint_residuals(diagnostics: DataFrame) -> DataFrame:
    """Largest and mean absolute net, beta and sector length."""
    return diagnostics.agg(
        F.max(F.abs("net")).alias("max_net"), F.avg(F.abs("net")).alias("mean_net"),
        F.max(F.abs("beta")).alias("max_beta"), F.avg(F.abs("beta")).alias("mean_beta"),
        F.max("sector_l2").alias("max_sector_l2"), F.avg("sector_l2").alias("mean_sector_l2"),
    )


def infeasible_ratio(days: DataFrame, flag: str = "infeasible") -> DataFrame:
    """Flagged days over all days."""
    n = F.count("*")
    return days.agg(
        F.count_if(F.col(flag)).alias("infeasible_days"), n.alias("n_days"),
        (F.count_if(F.col(flag)) / F.greatest(n, F.lit(1))).alias("ratio"),
    )


def report_join(returns: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """Returns with diagnostics on the date; the second ``ret`` becomes ``ret_diag``."""
    return returns.join(diagnostics.withColumnRenamed("ret", "ret_diag"), "date", "left")

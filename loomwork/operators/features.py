"""Return, momentum, volatility and alpha features over a dense panel ``(date, asset, close)``.

All windows share one specification (asset, ordered by date): one shuffle and one sort serve them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

def by_asset():
    """Window over one asset's rows in date order."""
    return W.partitionBy("asset").orderBy("date")


FEATURES = ["mom_1m", "mom_3m", "mom_6m", "vol_20", "rev_5"]


def pct_change(n: int, close: str = "close") -> Column:
    """n-row return; null where there is no earlier value or it is zero."""
    return F.try_divide(F.col(close), F.lag(close, n).over(by_asset())) - 1


def safe_return(n: int) -> Column:
    """n-row return, missing and infinite ones as 0."""
    return F.coalesce(pct_change(n), F.lit(0.0))


def full_stddev(column: str, n: int) -> Column:
    """Sample deviation of the last ``n`` rows; null unless all of them hold a value."""
    frame = by_asset().rowsBetween(-(n - 1), 0)
    return F.when(F.count(column).over(frame) == n, F.stddev_samp(column).over(frame))


def safe_pct_change(dense: DataFrame, n: int = 1) -> DataFrame:
    return dense.select("date", "asset", safe_return(n).alias("ret"))


def daily_returns(dense: DataFrame) -> DataFrame:
    """One-row returns, missing as 0."""
    return safe_pct_change(dense, 1)


def momentum_features(dense: DataFrame) -> DataFrame:
    return dense.select(
        "date", "asset", safe_return(20).alias("mom_1m"), safe_return(63).alias("mom_3m"), safe_return(126).alias("mom_6m")
    )


def realised_vol_20(dense: DataFrame) -> DataFrame:
    """Deviation of 20 zero-filled daily returns; 0 for the first 19 rows."""
    return daily_returns(dense).select("date", "asset", F.coalesce(full_stddev("ret", 20), F.lit(0.0)).alias("vol_20"))


def reversal_5(dense: DataFrame) -> DataFrame:
    return dense.select("date", "asset", (-safe_return(5)).alias("rev_5"))


def next_day_target(dense: DataFrame) -> DataFrame:
    """The next row's return; the last date has none and is left out."""
    return daily_returns(dense).select("date", "asset", F.lead("ret", 1).over(by_asset()).alias("target")).dropna(subset=["target"])


def build_features(dense: DataFrame) -> DataFrame:
    """Five features and the next-day target, one row per (date, asset), last date left out."""
    base = dense.select(
        "date", "asset", safe_return(1).alias("ret"), safe_return(20).alias("mom_1m"), safe_return(63).alias("mom_3m"),
        safe_return(126).alias("mom_6m"), (-safe_return(5)).alias("rev_5"),
    )
    return base.select(
        "date", "asset", "mom_1m", "mom_3m", "mom_6m", F.coalesce(full_stddev("ret", 20), F.lit(0.0)).alias("vol_20"),
        "rev_5", F.lead("ret", 1).over(by_asset()).alias("target"),
    ).dropna(subset=["target"])


def align_features_target(features: DataFrame, target: DataFrame) -> DataFrame:
    """Rows present on both sides."""
    return features.join(target, ["date", "asset"])


def forward_returns(dense: DataFrame, horizon: int = 5) -> DataFrame:
    """Return from each row to the ``horizon``-th next one."""
    ahead = F.lead("close", horizon).over(by_asset())
    return dense.select("date", "asset", (F.try_divide(ahead, F.col("close")) - 1).alias("fwd_ret"))


# Window length in rows and weight of each mean of daily returns.
ALPHA_MIX = [(20, 0.4), (63, 0.3), (126, 0.3)]


def expected_alpha(dense: DataFrame) -> DataFrame:
    """Weighted means of raw daily returns; 0 until the longest window is full."""
    return with_alpha(dense).select("date", "asset", "alpha")


def with_alpha(dense: DataFrame) -> DataFrame:
    """Add ``ret`` (missing as 0) and ``alpha``, so that a backtest can go on without joining them back.

    A window's mean is the difference of two running sums: constant work per row however long the window.
    """
    past = by_asset().rowsBetween(W.unboundedPreceding, 0)
    raw = dense.withColumn("ret", pct_change(1))
    summed = raw.withColumns({"_sum": F.sum("ret").over(past), "_known": F.count("ret").over(past)})
    mix = None
    for n, weight in ALPHA_MIX:
        earlier, known = (F.coalesce(F.lag(c, n).over(by_asset()), F.lit(0)) for c in ("_sum", "_known"))
        mean = F.when(F.col("_known") - known == n, (F.col("_sum") - earlier) / n)
        mix = F.lit(weight) * mean if mix is None else mix + F.lit(weight) * mean
    done = summed.withColumns({"alpha": F.coalesce(mix, F.lit(0.0)), "ret": F.coalesce("ret", F.lit(0.0))})
    return done.drop("_sum", "_known")


def ts_cv_folds(rows: DataFrame, folds: int = 3) -> DataFrame:
    """Expanding, time-ordered folds over rows ordered by (date, asset): ``(…, row, fold, role)``.

    Row numbers are the rows of earlier dates (a running sum over the calendar, one row per date) plus the
    position within the date, so no window spans the whole table.
    """
    per_day = rows.groupBy("date").agg(F.count("*").alias("_n"))
    calendar = W.orderBy("date")
    before = per_day.select(
        "date", (F.sum("_n").over(calendar) - F.col("_n")).alias("_before"),
        F.sum("_n").over(calendar.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("_total"),
    )
    place = F.row_number().over(W.partitionBy("date").orderBy("asset"))
    numbered = rows.withColumn("_place", place).join(F.broadcast(before), "date").withColumn("row", F.col("_before") + F.col("_place") - 1)
    size = F.floor(F.col("_total") / F.lit(folds + 1))
    spread = numbered.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    start = F.col("_total") - (F.lit(folds + 1) - F.col("fold")) * size
    role = F.when(F.col("row") < start, F.lit("train")).when(F.col("row") < start + size, F.lit("test"))
    return spread.withColumn("role", role).drop("_place", "_before", "_total").dropna(subset=["role"])

"""Sectors, betas, exposures, covariance and weight clean-up on long tables.

A universe of assets is a dimension (thousands of rows) and a calendar holds one row per day; the row-scale
tables are the (date, asset) panels.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.operators.blocks import by_block_pair
from loomwork.operators.features import by_asset, pct_change
from loomwork.session import sized

# The eleven sector names, in the order the hash picks from.
SECTORS = [
    "Energy", "Materials", "Industrials", "Consumer Discretionary", "Consumer Staples", "Health Care", "Financials",
    "Information Technology", "Communication Services", "Utilities", "Real Estate",
]


def hashed_sector(asset: str | Column = "asset") -> Column:
    """sha1(name) modulo 11 as a sector name.

    The 160-bit number is summed in four pieces of ten hex digits, which keeps the residue: 16**10 leaves 1.
    """
    digest = F.sha1(F.col(asset) if isinstance(asset, str) else asset)
    pieces = [F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 10).cast("bigint") for i in range(4)]
    index = (pieces[0] + pieces[1] + pieces[2] + pieces[3]) % len(SECTORS)
    return F.element_at(F.array(*[F.lit(s) for s in SECTORS]), (index + 1).cast("int"))


def sha1_sector(assets: DataFrame) -> DataFrame:
    return assets.select("asset", hashed_sector().alias("sector"))


def sector_lookup(assets: DataFrame, sectors: DataFrame) -> DataFrame:
    """Sector of each asset from a map; assets not in it are ``Unknown``."""
    return assets.join(sectors, "asset", "left").withColumn("sector", F.coalesce("sector", F.lit("Unknown")))


def sector_one_hot(assets: DataFrame, sectors: DataFrame | None = None) -> DataFrame:
    """Loadings (factor, asset, 1.0) of the sector each asset belongs to; zero cells are not stored."""
    placed = sha1_sector(assets) if sectors is None else sector_lookup(assets, sectors)
    return placed.select(F.col("sector").alias("factor"), "asset", F.lit(1.0).alias("loading"))


def with_market(returns: DataFrame) -> DataFrame:
    """Add the equal-weight market return of each date (one broadcast row per calendar day), unless it is there."""
    if "mkt" in returns.columns:
        return returns
    market = returns.groupBy("date").agg(F.avg("ret").alias("mkt"))
    return returns.join(F.broadcast(market), "date")


def _slope(cov: Column, var: Column) -> Column:
    return F.coalesce(F.try_divide(cov, var), F.lit(0.0))


def beta_to_market(returns: DataFrame) -> DataFrame:
    """Slope of each asset on the equal-weight market over all rows given; missing as 0."""
    return with_market(returns).groupBy("asset").agg(_slope(F.covar_samp("ret", "mkt"), F.var_samp("mkt")).alias("beta"))


def rolling_beta(returns: DataFrame, rows: int = 60) -> DataFrame:
    """Add the same slope over each asset's trailing rows; 0 until there are two."""
    frame = by_asset().rowsBetween(-(rows - 1), 0)
    slope = _slope(F.covar_samp("ret", "mkt").over(frame), F.var_samp("mkt").over(frame))
    beta = F.when(F.count("ret").over(frame) < 2, F.lit(0.0)).otherwise(slope)
    return with_market(returns).withColumn("beta", beta).drop("mkt")


def exposure_matrix(returns: DataFrame, sectors: DataFrame | None = None) -> DataFrame:
    """Sector loadings and the ``MKT`` beta row, as (factor, asset, loading)."""
    one_hot = sector_one_hot(returns.select("asset").distinct(), sectors)
    betas = beta_to_market(returns).select(F.lit("MKT").alias("factor"), "asset", F.col("beta").alias("loading"))
    return one_hot.unionByName(betas)


def portfolio_exposures(weights: DataFrame, exposures: DataFrame) -> DataFrame:
    """Sum of loading × weight per (date, factor)."""
    return weights.join(exposures, "asset").groupBy("date", "factor").agg(F.sum(F.col("loading") * F.col("w")).alias("exposure"))


def asof_exposures(weights: DataFrame, loadings: DataFrame) -> DataFrame:
    """Sum of weight × loading per (date, factor), with loadings given by the caller as ``(date, factor, asset, loading)``.

    Each weight takes, per factor of its asset, the loading of the latest row dated on or before its date; a row
    without a date holds from the start. Of rows with equal (factor, asset, date) the larger loading counts. A weight
    with no such row adds nothing; a (date, factor) without any gives null. Loadings and weights meet in one window per
    (factor, asset), ordered by date: no join over dates.
    """
    start = F.lit("0001-01-01").cast("date")
    rows = loadings.select(F.coalesce(F.col("date").cast("date"), start).alias("date"), "factor", "asset",
                           F.col("loading").cast("double").alias("loading"), F.lit(0).alias("_kind"), F.lit(None).cast("double").alias("w"))
    pairs = loadings.select("factor", "asset").distinct()
    asked = weights.join(pairs, "asset").select(F.col("date").cast("date").alias("date"), "factor", "asset",
                                                F.lit(None).cast("double").alias("loading"), F.lit(1).alias("_kind"), F.col("w").cast("double").alias("w"))
    before = W.partitionBy("factor", "asset").orderBy("date", "_kind", "loading").rowsBetween(W.unboundedPreceding, 0)
    found = rows.unionByName(asked).withColumn("_l", F.last("loading", ignorenulls=True).over(before)).where("_kind = 1")
    return found.groupBy("date", "factor").agg(F.sum(F.col("w") * F.col("_l")).alias("exposure"))


def neutrality_band(exposures: DataFrame, beta_tol: float, sector_tol: float, beta_target: float = 0.0) -> DataFrame:
    """Is each (date, factor) exposure within its band; the market factor has its own target and width."""
    is_market = F.col("factor") == "MKT"
    target = F.when(is_market, F.lit(beta_target)).otherwise(F.lit(0.0))
    width = F.when(is_market, F.lit(beta_tol)).otherwise(F.lit(sector_tol))
    return exposures.select("date", "factor", "exposure", (F.abs(F.col("exposure") - target) <= width).alias("within"))


def neutrality_pass_rate(bands: DataFrame) -> DataFrame:
    """Share of days on which every factor is within its band."""
    days = bands.groupBy("date").agg(F.bool_and("within").alias("ok"))
    return days.agg(F.avg(F.col("ok").cast("double")).alias("pass_rate"), F.count("*").alias("n_days"))


def signal_weights(raw: DataFrame, cap: float, gross_limit: float, net_target: float = 0.0) -> DataFrame:
    """Clean raw weights ``w`` per date: clip, shift to the net target, scale down to the gross limit, shift again.

    The three passes share one partitioning by date, so there is one shuffle.
    """
    day = W.partitionBy("date")

    def shifted(df: DataFrame) -> DataFrame:
        off = F.sum("w").over(day) - net_target
        return df.withColumn("w", F.when(F.abs(off) > 1e-9, F.col("w") - off / F.count("w").over(day)).otherwise(F.col("w")))

    clipped = raw.withColumn("w", F.greatest(F.lit(-cap), F.least(F.lit(cap), F.col("w"))))
    gross = F.sum(F.abs("w")).over(day)
    scaled = shifted(clipped).withColumn(
        "w", F.when(gross > gross_limit, F.col("w") * (F.lit(gross_limit) / (gross + 1e-12))).otherwise(F.col("w"))
    )
    return shifted(scaled)


def demeaned(panel: DataFrame, value: str = "alpha") -> DataFrame:
    """Add values less their mean of the date, as raw weights ``w``."""
    return panel.withColumn("w", F.col(value) - F.avg(value).over(W.partitionBy("date")))


_NO_NAMES, _NO_NUMBERS = np.array([], dtype=object), np.array([], dtype=float)  # typed empty columns


# --- covariance ------------------------------------------------------------

def _two_sides(group: pd.DataFrame):
    """The block pair as (dates, left matrix, left names, right matrix, right names, same block?)."""
    wide = group.pivot(index="date", columns="asset", values="ret").sort_index()
    own = group.drop_duplicates("asset").set_index("asset")["_own"]
    low, high = int(group["bi"].iloc[0]), int(group["bj"].iloc[0])
    left = [a for a in wide.columns if own[a] == low]
    right = [a for a in wide.columns if own[a] == high]
    return wide.index, wide[left].to_numpy(float), left, wide[right].to_numpy(float), right, low == high


def _pairs(left, right, same):
    """Index pairs to report, each pair once and named in order."""
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            if not same or a <= b:
                yield i, j, min(a, b), max(a, b)


SPAN_DAYS = 366  # calendar days of returns one group of cov_ridge holds


def cov_ridge(returns: DataFrame, ridge: float = 1e-6, block: int = 128, span_days: int = SPAN_DAYS) -> DataFrame:
    """Sample covariance over the dates two assets share, ridge on the diagonal; upper triangle (asset_a ≤ asset_b).

    Pairs sharing fewer than two dates get 0; a panel of fewer than two dates gives the identity. A group is a pair of
    asset blocks and one span of ``span_days`` days: it gives, per asset pair, masked cross-product sums of the returns
    less each asset's mean (dates where one of the two is missing count for neither), and the sums of all spans are
    added up by pair. No group holds more than two blocks of one span, however long the history.
    """
    n_dates = returns.agg(F.count_distinct("date").alias("n")).scalar()
    means = sized(returns.groupBy("asset").agg(F.avg("ret").alias("_mean")))
    centred = returns.select("date", "asset", "ret").join(means, "asset").select(
        "date", "asset", (F.col("ret") - F.col("_mean")).alias("ret"), F.floor(F.unix_date(F.col("date").cast("date")) / span_days).alias("_span"))

    def sums(group: pd.DataFrame) -> pd.DataFrame:
        _, x, left, y, right, same = _two_sides(group)
        empty = pd.DataFrame({"asset_a": _NO_NAMES, "asset_b": _NO_NAMES, "n": _NO_NUMBERS, "sx": _NO_NUMBERS, "sy": _NO_NUMBERS, "sxy": _NO_NUMBERS})
        if not left or not right:
            return empty
        mx, my = ~np.isnan(x), ~np.isnan(y)
        x0, y0 = np.where(mx, x, 0.0), np.where(my, y, 0.0)
        n, sx, sy, sxy = mx.T.astype(float) @ my, x0.T @ my, mx.T @ y0, x0.T @ y0
        picks = list(_pairs(left, right, same))
        if not picks:
            return empty
        i, j = np.array([p[0] for p in picks]), np.array([p[1] for p in picks])
        return pd.DataFrame({"asset_a": np.array([p[2] for p in picks], dtype=object), "asset_b": np.array([p[3] for p in picks], dtype=object),
                             "n": n[i, j], "sx": sx[i, j], "sy": sy[i, j], "sxy": sxy[i, j]})

    parts = by_block_pair(centred, "asset", block).groupBy("bi", "bj", "_span").applyInPandas(
        sums, "asset_a string, asset_b string, n double, sx double, sy double, sxy double")
    totals = parts.groupBy("asset_a", "asset_b").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxy")])
    cov = F.when(F.col("n") > 1, (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / (F.col("n") - 1)).otherwise(F.lit(0.0))
    same = (F.col("asset_a") == F.col("asset_b")).cast("double")
    return totals.withColumn("_n", n_dates).select(
        "asset_a", "asset_b", F.when(F.col("_n") < 2, same).otherwise(cov + same * ridge).alias("cov")
    )


def complete_dates(returns: DataFrame) -> DataFrame:
    """Rows of the dates on which every asset has a return."""
    known = returns.dropna(subset=["ret"])
    full = known.groupBy("date").agg(F.count("*").alias("n")).filter(F.col("n") == returns.agg(F.count_distinct("asset")).scalar())
    return known.join(full.select("date"), "date", "left_semi")


SPAN_ROWS = 750  # dates whose windows one group of rolling_cov ends, beside the rows - 1 dates before them


def rolling_cov(returns: DataFrame, rows: int = 60, block: int = 32, span_rows: int = SPAN_ROWS) -> DataFrame:
    """Trailing covariance of every asset pair on the dates all assets share; full windows only.

    The shared dates are numbered (one row a day) and cut into spans of ``span_rows``; a date is also sent, as history,
    to the later spans whose windows reach back to it (the next one only, when spans are at least ``rows - 1`` long). A group is a pair of asset blocks and one span, and gives the windows
    that end in its span, so no group holds the whole history.
    """
    shared = complete_dates(returns.select("date", "asset", "ret"))
    numbered = shared.select("date").distinct().select("date", (F.row_number().over(W.orderBy("date")) - 1).alias("_i"))
    placed = shared.join(sized(numbered), "date")
    # a date is history for every span whose windows reach back to it
    reach = F.floor((F.col("_i") + (rows - 1)) / span_rows) - F.floor(F.col("_i") / span_rows)
    sent = placed.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), reach.cast("long")))).select(
        "date", "asset", "ret", (F.floor(F.col("_i") / span_rows) + F.col("_copy")).alias("_span"), (F.col("_copy") == 0).alias("_native"))

    def roll(group: pd.DataFrame) -> pd.DataFrame:
        dates, x, left, y, right, same = _two_sides(group)
        first, second, values = [], [], []
        native = set(group.loc[group["_native"], "date"])
        ends = np.asarray(dates)[rows - 1:]
        keep = np.array([d in native for d in ends], dtype=bool)
        days = ends[keep]
        if len(days) and left and right:
            x, y = x - x.mean(axis=0), y - y.mean(axis=0)

            def trailing(v):
                total = np.vstack([np.zeros((1, v.shape[1])), np.cumsum(v, axis=0)])
                return total[rows:] - total[:-rows]

            sx, sy = trailing(x), trailing(y)
            for i in range(len(left)):
                # one row of the block at a time
                cov = (trailing(x[:, [i]] * y) - sx[:, [i]] * sy / rows) / (rows - 1)
                for _, j, a, b in _pairs([left[i]], right, same):
                    first.append(a)
                    second.append(b)
                    values.append(cov[keep, j])
        return pd.DataFrame({
            "date": np.tile(days, len(values)),
            "asset_a": np.repeat(np.array(first, dtype=object), len(days)),
            "asset_b": np.repeat(np.array(second, dtype=object), len(days)),
            "cov": np.concatenate(values) if values else _NO_NUMBERS,
        })

    return by_block_pair(sent, "asset", block).groupBy("bi", "bj", "_span").applyInPandas(
        roll, "date date, asset_a string, asset_b string, cov double"
    )


def raw_returns(dense: DataFrame) -> DataFrame:
    """One-row returns, first row of each asset null."""
    return dense.select("date", "asset", pct_change(1).alias("ret"))

"""Weights, exposures, backtests, statistics and release gates over daily prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.operators import backtest as bt
from loomwork.operators import features as ft
from loomwork.operators import gates
from loomwork.operators import panel as pn
from loomwork.operators import portfolio as pf
from loomwork.operators import stats
from loomwork.plans.market import ALPHA, DENSE, DENSE25, PX25, RETS, alphas, dense, ret_sql
from loomwork.plans.registry import register, select_sql
from loomwork.session import cut_lineage
from loomwork.sources.derived import prices, table

CAP, GROSS, SPREAD = 0.05, 0.2, 5.0

WTS = f"""{ALPHA},
w0 AS (SELECT date, asset, alpha - avg(alpha) OVER (PARTITION BY date) AS w FROM alphas),
w1 AS (SELECT date, asset, greatest(-{CAP}::DOUBLE, least({CAP}::DOUBLE, w)) AS w FROM w0),
w2 AS (SELECT date, asset, w - CASE WHEN abs(sum(w) OVER d) > 1e-9 THEN sum(w) OVER d / count(*) OVER d ELSE 0 END AS w
       FROM w1 WINDOW d AS (PARTITION BY date)),
w3 AS (SELECT date, asset, CASE WHEN sum(abs(w)) OVER d > {GROSS} THEN w * ({GROSS}::DOUBLE / (sum(abs(w)) OVER d + 1e-12)) ELSE w END AS w
       FROM w2 WINDOW d AS (PARTITION BY date)),
wts AS (SELECT date, asset, w - CASE WHEN abs(sum(w) OVER d) > 1e-9 THEN sum(w) OVER d / count(*) OVER d ELSE 0 END AS w
       FROM w3 WINDOW d AS (PARTITION BY date))"""


def strat_sql(spread=SPREAD, out="strat"):
    return f"""{out} AS (
  SELECT date, sum(coalesce(prev_w, 0) * ret) AS gross_ret, coalesce(sum(abs(w - prev_w)), 0) * {spread / 10000}::DOUBLE AS cost,
         sum(coalesce(prev_w, 0) * ret) - coalesce(sum(abs(w - prev_w)), 0) * {spread / 10000}::DOUBLE AS ret FROM book GROUP BY 1)"""


STRAT = f"""{WTS},
{ret_sql()},
book AS (SELECT r.date, r.asset, r.ret, coalesce(w.w, 0) AS w, lag(coalesce(w.w, 0)) OVER (PARTITION BY r.asset ORDER BY r.date) AS prev_w
         FROM rets r LEFT JOIN wts w ON w.date = r.date AND w.asset = r.asset),
{strat_sql()}"""

SUMMARY = f"""{STRAT},
cum AS (SELECT date, ret, product(1 + ret) OVER (ORDER BY date) AS cum, sum(ret) OVER (ORDER BY date) AS total FROM strat),
falls AS (SELECT *, cum / max(cum) OVER (ORDER BY date) - 1 AS dd, total - max(total) OVER (ORDER BY date) AS dd_sum FROM cum),
summary AS (SELECT CASE WHEN stddev_pop(ret) = 0 THEN 0 ELSE avg(ret) * 252 / (stddev_pop(ret) * sqrt(252)) END AS sharpe,
            pow(arg_max(cum, date), 1.0 / greatest(1.0, count(*) / 252.0)) - 1 AS cagr, min(dd) AS max_drawdown FROM falls)"""

SECTOR_SQL = ("list_extract([" + ", ".join(f"'{s}'" for s in pf.SECTORS) + "], CAST(("
              + " + ".join(f"CAST('0x' || substr(sha1(asset), {1 + 10 * i}, 10) AS BIGINT)" for i in range(4)) + ") % 11 AS INTEGER) + 1)")

BETA = f"""mkt AS (SELECT date, avg(ret) AS mkt FROM rets GROUP BY 1),
rm AS (SELECT r.date, r.asset, r.ret, m.mkt FROM rets r JOIN mkt m ON m.date = r.date),
betas AS (SELECT date, asset, CASE WHEN count(*) OVER w60 < 2 THEN 0 ELSE
          coalesce(covar_samp(ret, mkt) OVER w60 / nullif(var_samp(mkt) OVER w60, 0), 0) END AS beta
          FROM rm WINDOW w60 AS (PARTITION BY asset ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))"""

DIAG = f"""{STRAT},
{BETA},
held AS (SELECT b.date, {SECTOR_SQL.replace('sha1(asset)', 'sha1(b.asset)')} AS sector, coalesce(w.w, 0) AS w, b.beta
         FROM betas b LEFT JOIN wts w ON w.date = b.date AND w.asset = b.asset),
per_sector AS (SELECT date, sector, sum(w) AS w, sum(w * beta) AS wb FROM held GROUP BY 1, 2),
diag AS (SELECT p.date, max(s.ret) AS ret, sum(p.w) AS net, sum(p.wb) AS beta, sqrt(sum(p.w * p.w)) AS sector_l2
         FROM per_sector p JOIN strat s ON s.date = p.date GROUP BY 1)"""

EXPOSE = f"""{WTS},
{ret_sql()},
mkt AS (SELECT date, avg(ret) AS mkt FROM rets GROUP BY 1),
loads AS (SELECT {SECTOR_SQL} AS factor, asset, 1.0::DOUBLE AS loading FROM (SELECT DISTINCT asset FROM rets)
          UNION ALL SELECT 'MKT', asset, coalesce(covar_samp(ret, mkt) / nullif(var_samp(mkt), 0), 0) FROM rets r JOIN mkt m ON m.date = r.date GROUP BY asset),
expo AS (SELECT date, factor, sum(loading * w) AS exposure FROM wts JOIN loads USING (asset) GROUP BY 1, 2),
bands AS (SELECT date, factor, exposure, abs(exposure) <= CASE WHEN factor = 'MKT' THEN 0.01 ELSE 0.03 END AS within FROM expo)"""


def held(spark, folder):
    """Momentum weights next to the returns they earn: one chain of windows, no join."""
    return pf.signal_weights(pf.demeaned(ft.with_alpha(dense(spark, folder))), CAP, GROSS).select("date", "asset", "ret", "w")


def weights(spark, folder):
    return held(spark, folder).select("date", "asset", "w")


def series(spark, folder, spread=SPREAD):
    return bt.strategy_returns(held(spark, folder), spread)


def exposures(spark, folder):
    kept = cut_lineage(held(spark, folder))
    return pf.portfolio_exposures(kept.select("date", "asset", "w"), pf.exposure_matrix(kept.select("date", "asset", "ret")))


def diagnostics(spark, folder):
    return bt.daily_diagnostics(held(spark, folder), SPREAD)


# --- weights and exposures ---------------------------------------------------

@register("signal_weights", select_sql(WTS, "wts", "date asset", "w"))
def _(spark, folder):
    return weights(spark, folder)


@register("sha1_sector", f"SELECT DISTINCT asset, {SECTOR_SQL} AS sector FROM (SELECT p_name AS asset FROM part)")
def _(spark, folder):
    return pf.sha1_sector(table(spark, folder, "part").select(F.col("p_name").alias("asset")).distinct())


MAP_SQL = "smap AS (SELECT p_brand AS asset, min(p_type) AS sector FROM part GROUP BY 1 HAVING avg(p_size) > 25.5)"


def _sector_map(spark, folder):
    brands = table(spark, folder, "part").groupBy(F.col("p_brand").alias("asset"))
    return brands.agg(F.min("p_type").alias("sector"), F.avg("p_size").alias("size")).filter("size > 25.5").drop("size")


@register("sector_lookup", f"WITH {MAP_SQL} SELECT asset, coalesce(sector, 'Unknown') AS sector FROM (SELECT DISTINCT p_brand AS asset FROM part) LEFT JOIN smap USING (asset)")
def _(spark, folder):
    assets = table(spark, folder, "part").select(F.col("p_brand").alias("asset")).distinct()
    return pf.sector_lookup(assets, _sector_map(spark, folder))


@register("sector_one_hot", f"WITH {MAP_SQL} SELECT coalesce(sector, 'Unknown') AS factor, asset, 1.0::DOUBLE AS loading FROM (SELECT DISTINCT p_brand AS asset FROM part) LEFT JOIN smap USING (asset)")
def _(spark, folder):
    assets = table(spark, folder, "part").select(F.col("p_brand").alias("asset")).distinct()
    return pf.sector_one_hot(assets, _sector_map(spark, folder))


@register("exposure_matrix", select_sql(EXPOSE, "loads", "factor asset", "loading"))
def _(spark, folder):
    return pf.exposure_matrix(ft.daily_returns(dense(spark, folder)))


@register("portfolio_exposures", select_sql(EXPOSE, "expo", "date factor", "exposure"))
def _(spark, folder):
    return exposures(spark, folder)


ASOF = f"""{WTS},
ld AS (SELECT DATE '0001-01-01' AS date, {SECTOR_SQL} AS factor, asset, 1.0::DOUBLE AS loading FROM (SELECT DISTINCT asset FROM wts)
       UNION ALL SELECT date, 'ALPHA', asset, alpha FROM alphas WHERE day(date) = 1),
pairs AS (SELECT DISTINCT factor, asset FROM ld),
asked AS (SELECT w.date, p.factor, w.asset, w.w FROM wts w JOIN pairs p USING (asset)),
took AS (SELECT a.date, a.factor, a.w * l.loading AS part FROM asked a ASOF LEFT JOIN ld l ON a.factor = l.factor AND a.asset = l.asset AND a.date >= l.date),
asof_expo AS (SELECT date, factor, sum(part) AS exposure FROM took GROUP BY 1, 2)"""


@register("asof_exposures", select_sql(ASOF, "asof_expo", "date factor", "exposure"))
def _(spark, folder):
    """Exposures to loadings given as a table: sectors without a date, and each asset's alpha on the first day of a month,
    held until the next one."""
    w = weights(spark, folder)
    sectors = w.select("asset").distinct().select(F.lit(None).cast("date").alias("date"), pf.hashed_sector().alias("factor"), "asset",
                                                   F.lit(1.0).alias("loading"))
    monthly = alphas(spark, folder).where(F.dayofmonth("date") == 1).select("date", F.lit("ALPHA").alias("factor"), "asset", F.col("alpha").alias("loading"))
    return pf.asof_exposures(w, sectors.unionByName(monthly))


@register("neutrality_band", select_sql(EXPOSE, "bands", "date factor within", "exposure"))
def _(spark, folder):
    return pf.neutrality_band(exposures(spark, folder), 0.01, 0.03)


@register("neutrality_pass_rate", f"""WITH {EXPOSE}, d AS (SELECT date, bool_and(within) AS ok FROM bands GROUP BY 1)
SELECT round(avg(CAST(ok AS INTEGER)), 6) + 0.0 AS pass_rate, count(*) AS n_days FROM d""")
def _(spark, folder):
    return pf.neutrality_pass_rate(pf.neutrality_band(exposures(spark, folder), 0.01, 0.03))


@register("beta_to_market", f"""WITH {DENSE25}, {ret_sql()}, mkt AS (SELECT date, avg(ret) AS mkt FROM rets GROUP BY 1)
SELECT asset, round(coalesce(covar_samp(ret, mkt) / nullif(var_samp(mkt), 0), 0), 6) + 0.0 AS beta FROM rets r JOIN mkt m ON m.date = r.date GROUP BY 1""")
def _(spark, folder):
    return pf.beta_to_market(ft.daily_returns(dense(spark, folder, "p_brand")))


@register("rolling_beta_60", select_sql(f"{RETS},\n{BETA}", "betas", "date asset", "beta"))
def _(spark, folder):
    return pf.rolling_beta(ft.daily_returns(dense(spark, folder)), 60).select("date", "asset", "beta")


SPARSE = f"""{PX25}, rets AS (SELECT date, asset, close / nullif(lag(close) OVER (PARTITION BY asset ORDER BY date), 0) - 1 AS ret FROM px)"""


@register("cov_ridge", f"""WITH {SPARSE}, r AS (SELECT * FROM rets WHERE ret IS NOT NULL)
SELECT a.asset AS asset_a, b.asset AS asset_b,
       round(coalesce(covar_samp(a.ret, b.ret), 0) + CASE WHEN a.asset = b.asset THEN 1e-6 ELSE 0 END, 6) + 0.0 AS cov
FROM r a JOIN r b ON a.date = b.date AND a.asset <= b.asset GROUP BY 1, 2""")
def _(spark, folder):
    """Pairwise-complete covariance of the brand returns (brands do not trade on every date)."""
    px = prices(spark, folder, "p_brand")
    return pf.cov_ridge(pf.raw_returns(px).dropna(subset=["ret"]))


@register("rolling_cov_60", f"""WITH {DENSE}, {ret_sql(zero=False)},
full_days AS (SELECT date FROM rets WHERE ret IS NOT NULL GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT asset) FROM rets)),
r AS (SELECT * FROM rets WHERE date IN (SELECT date FROM full_days)),
p AS (SELECT a.date, a.asset AS asset_a, b.asset AS asset_b, covar_samp(a.ret, b.ret) OVER w AS cov, count(*) OVER w AS n
      FROM r a JOIN r b ON a.date = b.date AND a.asset <= b.asset
      WINDOW w AS (PARTITION BY a.asset, b.asset ORDER BY a.date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))
SELECT date, asset_a, asset_b, round(cov, 6) + 0.0 AS cov FROM p WHERE n = 60""")
def _(spark, folder):
    return pf.rolling_cov(pf.raw_returns(dense(spark, folder)), 60)


# --- backtest ---------------------------------------------------------------

@register("lagged_portfolio_return", select_sql(STRAT, "strat", "date", "gross_ret"))
def _(spark, folder):
    return bt.lagged_portfolio_return(held(spark, folder))


@register("turnover_cost", select_sql(STRAT, "strat", "date", "cost", digits=8), digits=8)
def _(spark, folder):
    return bt.turnover_cost(held(spark, folder), SPREAD)


@register("strategy_returns", select_sql(STRAT, "strat", "date", "ret"))
def _(spark, folder):
    """A table of weights against a table of prices."""
    return bt.strategy_returns(bt.book(dense(spark, folder), weights(spark, folder)), SPREAD)


@register("backtest_summary", select_sql(SUMMARY, "summary", "", "sharpe cagr max_drawdown"))
def _(spark, folder):
    return bt.backtest_summary(series(spark, folder))


@register("signal_backtest", select_sql(SUMMARY, "summary", "", "sharpe cagr max_drawdown"))
def _(spark, folder):
    """Prices → alpha → weights → daily returns → summary, in one plan."""
    return bt.backtest_summary(bt.strategy_returns(held(spark, folder), SPREAD))


@register("cumulative_pnl", select_sql(SUMMARY, "cum", "date", "cum"))
def _(spark, folder):
    return bt.cumulative_pnl(series(spark, folder))


@register("rolling_sharpe_60", f"""WITH {STRAT}
SELECT date, round(CASE WHEN count(ret) OVER w = 60 THEN avg(ret) OVER w / (stddev_samp(ret) OVER w + 1e-12) * sqrt(252) END, 6) + 0.0 AS sharpe_60
FROM strat WINDOW w AS (ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""")
def _(spark, folder):
    return bt.rolling_sharpe(series(spark, folder), 60)


ARITH = f"""{SUMMARY},
arith AS (SELECT coalesce(avg(ret) * 252 / nullif(stddev_samp(ret) * sqrt(252), 0), 0) AS sharpe_annual, stddev_samp(ret) * sqrt(252) AS vol_annual,
          pow(1 + avg(ret), 252) - 1 AS cagr, min(dd_sum) AS max_dd, avg(CASE WHEN ret > 0 THEN 1.0::DOUBLE ELSE 0 END) AS hit_ratio FROM falls)"""


@register("arith_drawdown_metrics", select_sql(ARITH, "arith", "", "sharpe_annual vol_annual cagr max_dd hit_ratio"))
def _(spark, folder):
    return bt.arith_drawdown_metrics(series(spark, folder))


REAL = f"""{STRAT},
mv AS (SELECT date, w, lag(w) OVER (PARTITION BY asset ORDER BY date) AS prev_w FROM wts),
dd AS (SELECT date, sum(abs(w - prev_w)) / 2 AS turnover, sum(abs(w)) AS gross, count(*) FILTER (abs(w - prev_w) > 1e-12) AS trades, count(prev_w) AS known FROM mv GROUP BY 1),
real AS (SELECT coalesce(avg(turnover) FILTER (known > 0), 0) AS turnover_pct_day, avg(gross) AS avg_gross,
         coalesce(avg(trades) FILTER (known > 0), 0) AS trades_per_day,
         (SELECT avg(CASE WHEN ret > 0 THEN 1.0::DOUBLE ELSE 0 END) FROM strat) AS hit_ratio FROM dd)"""


@register("realised_metrics", select_sql(REAL, "real", "", "turnover_pct_day avg_gross trades_per_day hit_ratio"))
def _(spark, folder):
    return bt.realised_metrics(weights(spark, folder), series(spark, folder))


@register("daily_diagnostics", select_sql(DIAG, "diag", "date", "ret net beta sector_l2"))
def _(spark, folder):
    return diagnostics(spark, folder)


RESID = """resid AS (SELECT max(abs(net)) AS max_net, avg(abs(net)) AS mean_net, max(abs(beta)) AS max_beta, avg(abs(beta)) AS mean_beta,
          max(sector_l2) AS max_sector_l2, avg(sector_l2) AS mean_sector_l2 FROM diag)"""


@register("constraint_residuals", select_sql(f"{DIAG},\n{RESID}", "resid", "", "max_net mean_net max_beta mean_beta max_sector_l2 mean_sector_l2"))
def _(spark, folder):
    return bt.constraint_residuals(diagnostics(spark, folder))


@register("infeasible_ratio", select_sql(f"""{DIAG},
inf AS (SELECT count(*) FILTER (abs(beta) > 0.05) AS infeasible_days, count(*) AS n_days,
        count(*) FILTER (abs(beta) > 0.05) / greatest(count(*), 1) AS ratio FROM diag)""", "inf", "", "ratio", "infeasible_days n_days"))
def _(spark, folder):
    """Days whose beta leaves a 0.05 band, as the flagged ones."""
    days = diagnostics(spark, folder).select("date", (F.abs("beta") > 0.05).alias("infeasible"))
    return bt.infeasible_ratio(days)


@register("report_join", select_sql(f"{DIAG}, rep AS (SELECT s.date, s.ret, d.ret AS ret_diag, net, beta, sector_l2 FROM strat s LEFT JOIN diag d ON d.date = s.date AND abs(d.beta) <= 0.05)",
          "rep", "date", "ret ret_diag net beta sector_l2"))
def _(spark, folder):
    """All returns, with the diagnostics of the days inside the band."""
    return bt.report_join(series(spark, folder), diagnostics(spark, folder).filter(F.abs("beta") <= 0.05))


# --- statistics ---------------------------------------------------------------

@register("newey_west_sharpe_ci", select_sql(f"""{STRAT},
lg AS (SELECT ret, lag(ret, 1) OVER o AS l1, lag(ret, 2) OVER o AS l2, lag(ret, 3) OVER o AS l3, lag(ret, 4) OVER o AS l4 FROM strat WINDOW o AS (ORDER BY date)),
g AS (SELECT count(*) AS n, avg(ret) AS m, stddev_samp(ret) AS sd, var_pop(ret) + 2 * (0.8 * covar_samp(ret, l1) + 0.6 * covar_samp(ret, l2)
      + 0.4 * covar_samp(ret, l3) + 0.2 * covar_samp(ret, l4)) AS v FROM lg),
nw AS (SELECT m / sd * sqrt(252) AS sharpe, m / sd * sqrt(252) - 1.96 * sqrt(v / n) / sd * sqrt(252) AS lower,
       m / sd * sqrt(252) + 1.96 * sqrt(v / n) / sd * sqrt(252) AS upper FROM g)""", "nw", "", "sharpe lower upper"))
def _(spark, folder):
    return stats.newey_west_sharpe_ci(series(spark, folder))


@register("chunked_sharpe_pbo", select_sql(f"""{STRAT},
i AS (SELECT ret, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n FROM strat),
c AS (SELECT i // greatest(20, n // 10) AS chunk, avg(ret) AS m, stddev_samp(ret) AS s FROM i
      WHERE n >= 50 AND i // greatest(20, n // 10) < n // greatest(20, n // 10) GROUP BY 1 HAVING stddev_samp(ret) > 0),
p AS (SELECT coalesce(CASE WHEN count(*) < 2 OR abs(avg(m / s * sqrt(252))) < 1e-6 THEN 0
      ELSE least(1.0, stddev_pop(m / s * sqrt(252)) / abs(avg(m / s * sqrt(252)))) END, 0) AS pbo, count(*) AS n_chunks FROM c)""",
          "p", "", "pbo", "n_chunks"))
def _(spark, folder):
    return stats.chunked_sharpe_pbo(series(spark, folder))


@register("block_bootstrap_sharpe", select_sql(f"""{STRAT},
s AS (SELECT row_number() OVER (ORDER BY date) AS i, sum(ret) OVER (ORDER BY date) AS s, sum(ret * ret) OVER (ORDER BY date) AS q FROM strat
      UNION ALL SELECT 0, 0, 0),
nn AS (SELECT count(*) AS n FROM strat),
d AS (SELECT r.range AS replica, k.range AS slot, n, CAST('0x' || substr(md5(r.range || ',' || k.range), 1, 12) AS BIGINT) % (n - 19) AS start
      FROM range(10000) r, nn, range((SELECT CAST(ceil(count(*) / 20) AS BIGINT) FROM strat)) k),
e AS (SELECT replica, n, start, start + least(20, n - slot * 20) AS stop FROM d),
t AS (SELECT replica, max(n) AS n, sum(b.s - a.s) AS s, sum(b.q - a.q) AS q FROM e JOIN s a ON a.i = e.start JOIN s b ON b.i = e.stop GROUP BY 1),
u AS (SELECT s / n / sqrt((q - s * (s / n)) / (n - 1)) * sqrt(252) AS sharpe FROM t),
boot AS (SELECT quantile_cont(sharpe, 0.025) AS lower, quantile_cont(sharpe, 0.975) AS upper, count(*) AS replicas FROM u)""",
          "boot", "", "lower upper", "replicas"))
def _(spark, folder):
    return stats.block_bootstrap_sharpe(series(spark, folder))


# --- metrics and gates ----------------------------------------------------------

METRICS = f"""{ARITH},
mv AS (SELECT date, w, lag(w) OVER (PARTITION BY asset ORDER BY date) AS prev_w FROM wts),
dd AS (SELECT date, sum(abs(w - prev_w)) / 2 AS turnover, sum(abs(w)) AS gross, count(*) FILTER (abs(w - prev_w) > 1e-12) AS trades, count(prev_w) AS known FROM mv GROUP BY 1),
metrics AS (
  SELECT metric, value FROM (SELECT sharpe_annual, vol_annual, cagr, max_dd, hit_ratio FROM arith) UNPIVOT (value FOR metric IN (sharpe_annual, vol_annual, cagr, max_dd, hit_ratio))
  UNION ALL SELECT 'turnover_pct_day', coalesce(avg(turnover) FILTER (known > 0), 0) FROM dd)"""

LIMIT_SQL = "limits AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{p}', '{m}', '{op}', {v}::DOUBLE)" for p, items in gates.LIMITS.items() for m, (op, v) in items.items()
) + ") t(profile, metric, op, bound))"

GATED = f"""{METRICS},
{LIMIT_SQL},
gated AS (SELECT profile, l.metric, op, bound, CASE WHEN l.metric = 'max_dd' THEN abs(value) ELSE value END AS v FROM limits l LEFT JOIN metrics m ON m.metric = l.metric),
checked AS (SELECT profile, metric, op, bound, v AS value, coalesce(CASE WHEN op = 'min' THEN v < bound ELSE v > bound END, false) AS violated, v IS NULL AS missing FROM gated)"""


def run_metrics(spark, folder):
    """Metrics of the momentum signal, long."""
    kept = cut_lineage(held(spark, folder))
    returns = bt.strategy_returns(kept, SPREAD)
    summary = gates.to_metrics(bt.arith_drawdown_metrics(returns))
    moved = bt.realised_metrics(kept.select("date", "asset", "w"), returns).select("turnover_pct_day")
    return summary.unionByName(gates.to_metrics(moved))


@register("threshold_gate", f"""WITH {GATED}
SELECT profile, CASE WHEN bool_or(violated) THEN 'FAILED' ELSE 'PASSED' END AS status,
       coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (violated), '') AS violations,
       coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (missing), '') AS missing, count(*) AS n_limits FROM checked GROUP BY 1""")
def _(spark, folder):
    return gates.threshold_gate(run_metrics(spark, folder), gates.limits_table(spark))


@register("metric_diff", select_sql(f"""{STRAT},
a AS (SELECT 'd' || strftime(date, '%Y%m%d') AS metric, round(ret, 4) AS value FROM strat),
b AS (SELECT 'd' || strftime(date, '%Y%m%d') AS metric, round(gross_ret, 4) AS value FROM strat WHERE day(date) % 7 <> 3),
df AS (SELECT coalesce(a.metric, b.metric) AS metric, a.value AS old_value, b.value AS new_value FROM a FULL OUTER JOIN b ON a.metric = b.metric
       WHERE a.value IS DISTINCT FROM b.value)""", "df", "metric", "old_value new_value"))
def _(spark, folder):
    """Days whose return changes when costs are left out, at four digits; the second run lacks scattered days."""
    name = F.concat(F.lit("d"), F.date_format("date", "yyyyMMdd")).alias("metric")
    old = series(spark, folder).select(name, F.round("ret", 4).alias("value"))
    free = bt.lagged_portfolio_return(held(spark, folder))
    new = free.filter(F.dayofmonth("date") % 7 != 3).select(name, F.round("gross_ret", 4).alias("value"))
    return gates.metric_diff(old, new)


@register("missing_required_metrics", f"WITH {METRICS},\n{LIMIT_SQL} SELECT DISTINCT metric FROM limits WHERE metric NOT IN (SELECT metric FROM metrics WHERE value IS NOT NULL)")
def _(spark, folder):
    required = gates.limits_table(spark).select("metric").distinct()
    return gates.missing_required_metrics(run_metrics(spark, folder), required)


@register("flatten_metrics_json", """
SELECT event_id, 'k' AS metric, round(CAST(json_extract_string(props, '$.k') AS DOUBLE), 6) + 0.0 AS value FROM events
WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def _(spark, folder):
    return gates.flatten_metrics_json(table(spark, folder, "events"), "props", ["k", "missing.path"], ["event_id"])


@register("read_monthly_panel", f"""WITH {PX25} SELECT date, asset, round(close, 6) + 0.0 AS close FROM px""")
def _(spark, folder):
    """Write the brand panel in month folders, add an overlapping later slice, read back keeping the last copy."""
    from loomwork.session import fresh_path
    from loomwork.sources.files import read_monthly_panel, write_month_partitions

    path = fresh_path(spark, "panel")
    px = prices(spark, folder, "p_brand")
    write_month_partitions(px.withColumn("close", -F.col("close")), f"{path}/slice_1")
    write_month_partitions(px, f"{path}/slice_2")
    return read_monthly_panel(spark, f"{path}/slice_*")


@register("write_month_partitions", f"WITH {PX25} SELECT strftime(date, '%Y%m')::BIGINT AS ym, count(*) AS n_rows FROM px GROUP BY 1")
def _(spark, folder):
    """Rows per month folder, as written and read back (the folder names give ``ym``)."""
    from loomwork.session import fresh_path
    from loomwork.sources.files import write_month_partitions

    path = fresh_path(spark, "months")
    write_month_partitions(prices(spark, folder, "p_brand"), path)
    return spark.read.parquet(path).groupBy(F.col("ym").cast("bigint").alias("ym")).agg(F.count("*").alias("n_rows"))


BAR_SQL = """bars AS (SELECT CAST(l_shipdate AS DATE) AS date, p_brand AS ticker, min(l_extendedprice) AS low, max(l_extendedprice) AS high,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)"""


@register("price_table", f"""WITH {BAR_SQL} SELECT date, ticker, NULL::DOUBLE AS "open", round(high, 6) + 0.0 AS high, round(low, 6) + 0.0 AS low, NULL::DOUBLE AS "close", volume FROM bars""")
def _(spark, folder):
    """Typed daily bars written in month folders; every bar is given twice and kept once."""
    from loomwork.session import fresh_path
    from loomwork.sources.files import price_table

    path = fresh_path(spark, "bars")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("ticker"))
    bars = table(spark, folder, "lineitem").join(parts, "l_partkey").groupBy(F.to_date("l_shipdate").alias("date"), "ticker").agg(
        F.max("l_extendedprice").alias("high"), F.min("l_extendedprice").alias("low"), F.sum(F.col("l_quantity").cast("bigint")).alias("volume")
    ).withColumns({"open": F.lit(None).cast("double"), "close": F.lit(None).cast("double")})
    price_table(bars.unionByName(bars), path)
    return spark.read.parquet(path).drop("ym")


@register("concat_monthlies", select_sql(STRAT, "strat", "date", "ret"))
def _(spark, folder):
    """Strategy returns written as one CSV folder per month and read back as one series."""
    from loomwork.session import fresh_path
    from loomwork.sources.files import concat_monthlies, write_monthly_csv

    path = fresh_path(spark, "monthly")
    write_monthly_csv(series(spark, folder), path, "returns")
    return concat_monthlies(spark, path, "returns", "ret double")


@register("write_metrics_json", select_sql(SUMMARY, "summary", "", "sharpe cagr max_drawdown"))
def _(spark, folder):
    """The backtest summary written as JSON and read back."""
    from loomwork.session import fresh_path
    from loomwork.sources.files import write_metrics_json

    path = fresh_path(spark, "metrics")
    write_metrics_json(bt.backtest_summary(series(spark, folder)), path)
    return spark.read.schema("sharpe double, cagr double, max_drawdown double").json(path)


@register("storage_profile", f"WITH {PX25} SELECT count(DISTINCT strftime(date, '%Y%m')) AS n_months, true AS has_bytes FROM px")
def _(spark, folder):
    """Months and bytes of the month-partitioned brand panel, from the file listing."""
    from loomwork.session import fresh_path
    from loomwork.sources.files import storage_profile, write_month_partitions

    path = fresh_path(spark, "profile")
    write_month_partitions(prices(spark, folder, "p_brand"), path)
    return storage_profile(spark, path).select("n_months", (F.col("total_bytes") > 0).alias("has_bytes"))

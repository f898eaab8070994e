"""Panel, feature and calendar queries over daily prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.operators import features as ft
from loomwork.operators import panel as pn
from loomwork.plans.registry import register, select_sql
from loomwork.session import cut_lineage
from loomwork.sources.derived import prices, prices_sql, supplier_prices, table


PX = prices_sql()
PX25 = prices_sql("p_brand")


def dense_sql(src="px", out="dense"):
    return f"""{out} AS (
  SELECT c.date, a.asset, last_value(p.close IGNORE NULLS) OVER (PARTITION BY a.asset ORDER BY c.date
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close
  FROM (SELECT DISTINCT date FROM {src}) c CROSS JOIN (SELECT DISTINCT asset FROM {src}) a
  LEFT JOIN {src} p ON p.date = c.date AND p.asset = a.asset)"""


def ret_sql(src="dense", out="rets", zero=True):
    raw = "close / nullif(lag(close) OVER (PARTITION BY asset ORDER BY date), 0) - 1"
    return f"{out} AS (SELECT date, asset, {'coalesce(' + raw + ', 0)' if zero else raw} AS ret FROM {src})"


def pct(n):
    return f"coalesce(close / nullif(lag(close, {n}) OVER (PARTITION BY asset ORDER BY date), 0) - 1, 0)"


DENSE = f"{PX},\n{dense_sql()}"
DENSE25 = f"{PX25},\n{dense_sql()}"
RETS = f"{DENSE},\n{ret_sql()}"

VOL = """coalesce(CASE WHEN count(ret) OVER w20 = 20 THEN stddev_samp(ret) OVER w20 END, 0)"""
W20 = "w20 AS (PARTITION BY asset ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"

FEAT = f"""{DENSE},
base AS (SELECT date, asset, {pct(1)} AS ret, {pct(20)} AS mom_1m, {pct(63)} AS mom_3m, {pct(126)} AS mom_6m,
         -({pct(5)}) AS rev_5 FROM dense),
feats0 AS (SELECT date, asset, ret, mom_1m, mom_3m, mom_6m, rev_5, {VOL} AS vol_20,
          lead(ret) OVER (PARTITION BY asset ORDER BY date) AS target FROM base WINDOW {W20}),
feats AS (SELECT * FROM feats0 WHERE target IS NOT NULL)"""


def alpha_sql(src="dense", out="alphas"):
    terms = " + ".join(
        f"{w}::DOUBLE * CASE WHEN count(ret) OVER w{n} = {n} THEN avg(ret) OVER w{n} END" for n, w in ft.ALPHA_MIX
    )
    wins = ", ".join(f"w{n} AS (PARTITION BY asset ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n, _ in ft.ALPHA_MIX)
    return f"""{ret_sql(src, 'raw_' + out, zero=False)},
{out} AS (SELECT date, asset, coalesce({terms}, 0) AS alpha FROM raw_{out} WINDOW {wins})"""


ALPHA = f"{DENSE},\n{alpha_sql()}"
FEATURE_COLS = "mom_1m mom_3m mom_6m vol_20 rev_5"


def dense(spark, folder, asset="p_type"):
    """The prices are stored once, small beside the lines: calendar, assets and closes are all read from there."""
    return pn.dense_panel(cut_lineage(prices(spark, folder, asset)))


def alphas(spark, folder):
    return ft.expected_alpha(dense(spark, folder))


# --- reshaping -------------------------------------------------------------

@register("close_panel", f"""WITH {PX}
SELECT date, round(max(close) FILTER (asset = 'ECONOMY'), 6) + 0.0 AS "ECONOMY",
       round(max(close) FILTER (asset = 'PROMO'), 6) + 0.0 AS "PROMO"
FROM px WHERE asset IN ('ECONOMY', 'PROMO') AND date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY date""")
def _(spark, folder):
    return pn.close_panel(prices(spark, folder), ["ECONOMY", "PROMO"], "1996-01-01", "1998-12-31")


def brand_prices(spark, folder):
    """Prices by brand, stored once, and the names found in them."""
    stored = cut_lineage(prices(spark, folder, "p_brand"))
    return stored, [r["asset"] for r in stored.select("asset").distinct().orderBy("asset").collect()]


# The 25 brand names of the part table, Brand#1 to Brand#25, named so that the SQL can be stored as a view.
BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@register("long_to_wide", f"""WITH {PX25}
SELECT date, {", ".join(f"max(round(close, 6) + 0.0) FILTER (asset = '{b}') AS \"{b}\"" for b in BRANDS)} FROM px GROUP BY date""")
def _(spark, folder):
    return pn.long_to_wide(*brand_prices(spark, folder))


@register("wide_to_long", select_sql(PX25, "px", "date asset", "close"))
def _(spark, folder):
    return pn.wide_to_long(pn.long_to_wide(*brand_prices(spark, folder)))


@register("available_tickers", f"WITH {PX25} SELECT DISTINCT asset FROM px WHERE date >= DATE '2000-01-01' AND date <= DATE '2000-03-31'")
def _(spark, folder):
    return pn.available_tickers(prices(spark, folder, "p_brand"), "2000-01-01", "2000-03-31")


@register("date_range", f"WITH {PX25} SELECT asset, min(date) AS first_date, max(date) AS last_date FROM px GROUP BY 1")
def _(spark, folder):
    return pn.date_range(prices(spark, folder, "p_brand"))


@register("asof_align", f"""WITH {PX25},
cal AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
steps AS (SELECT date, asset, close, 0 AS slot FROM px
          UNION ALL SELECT c.date, a.asset, NULL, 1 FROM cal c CROSS JOIN (SELECT DISTINCT asset FROM px) a),
fwd AS (SELECT date, asset, slot, last_value(close IGNORE NULLS) OVER (PARTITION BY asset ORDER BY date, slot
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close FROM steps),
out AS (SELECT date, asset, first_value(close IGNORE NULLS) OVER (PARTITION BY asset ORDER BY date
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS close FROM fwd WHERE slot = 1)
SELECT date, asset, round(close, 6) + 0.0 AS close FROM out""")
def _(spark, folder):
    """Brand prices as of every order date."""
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return pn.asof_align(prices(spark, folder, "p_brand"), days)


@register("ragged_to_panel", f"""WITH {PX25},
n AS (SELECT asset, close, row_number() OVER (PARTITION BY asset ORDER BY date) - 1 AS step FROM px),
grid AS (SELECT a.asset, s.step, n.close FROM (SELECT DISTINCT asset FROM n) a CROSS JOIN (SELECT DISTINCT step FROM n) s
         LEFT JOIN n ON n.asset = a.asset AND n.step = s.step)
SELECT CAST(step AS BIGINT) AS step, asset, round(last_value(close IGNORE NULLS) OVER (PARTITION BY asset ORDER BY step
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) + 0.0 AS close FROM grid""")
def _(spark, folder):
    """Per-brand price arrays of unequal length on a common step axis."""
    arrays = prices(spark, folder, "p_brand").groupBy("asset").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("date", "close"))), lambda r: r["close"]).alias("prices")
    )
    return pn.ragged_to_panel(arrays)


@register("canonical_ticker", """
SELECT DISTINCT upper(regexp_replace('  ' || lower(p_brand) || chr(9), '^\\s+|\\s+$', '', 'g')) AS asset FROM part""")
def _(spark, folder):
    raw = table(spark, folder, "part").select(F.concat(F.lit("  "), F.lower("p_brand"), F.lit("\t")).alias("asset"))
    return pn.canonical_ticker(raw).distinct()


@register("reindex_fill_zero", f"""WITH {PX25},
cal AS (SELECT DISTINCT date FROM px), w AS (SELECT date, asset, close / 7 AS w FROM px)
SELECT c.date, a.asset, round(coalesce(w.w, 0), 6) + 0.0 AS w FROM cal c CROSS JOIN (SELECT DISTINCT asset FROM px) a
LEFT JOIN w ON w.date = c.date AND w.asset = a.asset""")
def _(spark, folder):
    px = prices(spark, folder, "p_brand")
    weights = px.select("date", "asset", (F.col("close") / 7).alias("w"))
    return pn.reindex_fill_zero(weights, pn.spine(px, pn.calendar_of(px)))


@register("hold_weights_from", f"""WITH {ALPHA},
last AS (SELECT asset, alpha AS w FROM alphas WHERE date = (SELECT max(date) FROM alphas))
SELECT c.date, l.asset, round(CASE WHEN c.date >= DATE '2000-06-01' THEN l.w ELSE 0 END, 6) + 0.0 AS w
FROM (SELECT DISTINCT date FROM px) c CROSS JOIN last l""")
def _(spark, folder):
    px = prices(spark, folder)
    newest = pn.latest_cross_section(alphas(spark, folder)).select("asset", F.col("alpha").alias("w"))
    return pn.hold_weights_from(newest, pn.calendar_of(px), F.to_date(F.lit("2000-06-01")))


def _slices_sql():
    return f"""{PX},
s1 AS (SELECT date, asset, close, 1 AS slice FROM px WHERE date < DATE '1999-01-01'),
s2 AS (SELECT date, asset, close * 2 AS close, 2 AS slice FROM px WHERE date >= DATE '1998-06-01'),
both_slices AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2),
merged AS (SELECT date, asset, close FROM both_slices QUALIFY row_number() OVER (PARTITION BY date, asset ORDER BY slice DESC) = 1)"""


def _slices(spark, folder):
    px = prices(spark, folder)
    old = px.filter(F.col("date") < F.to_date(F.lit("1999-01-01")))
    new = px.filter(F.col("date") >= F.to_date(F.lit("1998-06-01"))).withColumn("close", F.col("close") * 2)
    return old, new


@register("union_dedupe_last", select_sql(_slices_sql(), "merged", "date asset", "close"))
def _(spark, folder):
    return pn.union_dedupe_last(_slices(spark, folder))


@register("upsert_bars", select_sql(_slices_sql(), "merged", "date asset", "close"))
def _(spark, folder):
    """The first slice stored by month; the second merged into the months it touches."""
    from loomwork.session import fresh_path
    from loomwork.sources.files import upsert_months, write_month_partitions

    old, new = _slices(spark, folder)
    path = fresh_path(spark, "bars")
    write_month_partitions(old, path)
    return upsert_months(spark, path, new).drop("ym")


@register("latest_cross_section", select_sql(FEAT, "feats", "date asset", FEATURE_COLS, tail="WHERE date = (SELECT max(date) FROM feats)"))
def _(spark, folder):
    return pn.latest_cross_section(ft.build_features(dense(spark, folder))).drop("target")


@register("read_latest_snapshot", select_sql(ALPHA, "alphas", "date asset", "alpha", tail="WHERE date = (SELECT max(date) FROM alphas)"))
def _(spark, folder):
    return pn.latest_cross_section(alphas(spark, folder))


@register("tail_rows", select_sql(ALPHA, "alphas", "date asset", "alpha",
          tail="WHERE date IN (SELECT DISTINCT date FROM alphas ORDER BY date DESC LIMIT 5)"))
def _(spark, folder):
    return pn.tail_rows(alphas(spark, folder), 5)


@register("alphas_for_tickers", select_sql(ALPHA, "alphas", "date asset", "alpha",
          tail="WHERE date = (SELECT max(date) FROM alphas) AND asset IN (SELECT p_type FROM part WHERE p_size >= 45)"))
def _(spark, folder):
    wanted = table(spark, folder, "part").filter("p_size >= 45").select(F.col("p_type").alias("asset"))
    return pn.alphas_for_tickers(alphas(spark, folder), wanted)


@register("align_to_feature_list", f"""WITH {FEAT}
SELECT date, asset, round(rev_5, 6) + 0.0 AS rev_5, round(mom_1m, 6) + 0.0 AS mom_1m, 0.0::DOUBLE AS beta,
       round(vol_20, 6) + 0.0 AS vol_20, true AS feature_skew FROM feats""")
def _(spark, folder):
    rows = ft.build_features(dense(spark, folder)).drop("target")
    return pn.align_to_feature_list(rows, ["date", "asset"], ["rev_5", "mom_1m", "beta", "vol_20"])


@register("drop_columns", select_sql(FEAT, "feats", "date asset", "mom_1m vol_20 target"))
def _(spark, folder):
    return ft.build_features(dense(spark, folder)).drop("mom_3m", "mom_6m", "rev_5")


@register("drop_missing_rows", f"""WITH {DENSE25},
f AS (SELECT date, asset, close / lag(close, 20) OVER (PARTITION BY asset ORDER BY date) - 1 AS raw_mom,
      lead(close) OVER (PARTITION BY asset ORDER BY date) AS nxt FROM dense)
SELECT date, asset, round(raw_mom, 6) + 0.0 AS raw_mom, round(nxt, 6) + 0.0 AS nxt FROM f WHERE raw_mom IS NOT NULL""")
def _(spark, folder):
    rows = dense(spark, folder, "p_brand").select(
        "date", "asset", ft.pct_change(20).alias("raw_mom"), F.lead("close", 1).over(ft.by_asset()).alias("nxt")
    )
    return rows.dropna(subset=["raw_mom"])


# --- profiles --------------------------------------------------------------

@register("panel_profile", f"""WITH {PX25}, d AS (SELECT DISTINCT date FROM px)
SELECT (SELECT count(*) FROM px) AS n_rows, (SELECT count(*) FROM d) AS n_dates,
       (SELECT min(date) FROM d) AS start, (SELECT max(date) FROM d) AS "end",
       (SELECT string_agg(CAST(date AS VARCHAR), ',' ORDER BY date) FROM (SELECT date FROM d ORDER BY date LIMIT 3)) AS head_dates,
       (SELECT string_agg(CAST(date AS VARCHAR), ',' ORDER BY date DESC) FROM (SELECT date FROM d ORDER BY date DESC LIMIT 3)) AS tail_dates,
       (SELECT count(DISTINCT asset) FROM px) AS n_assets""")
def _(spark, folder):
    return pn.panel_profile(prices(spark, folder, "p_brand"))


@register("panel_density", f"""WITH {PX25}, r AS (SELECT count(DISTINCT date) AS n_dates, max(date) - min(date) + 1 AS span_days FROM px)
SELECT n_dates, CAST(span_days AS BIGINT) AS span_days, round(n_dates / span_days, 6) + 0.0 AS density,
       n_dates / span_days BETWEEN 0.5 AND 1.0 AS within_bounds FROM r""")
def _(spark, folder):
    return pn.panel_density(prices(spark, folder, "p_brand"))


@register("panel_freshness", f"""WITH {PX25}
SELECT round((epoch(TIMESTAMP '2002-01-01') - epoch(CAST(max(date) AS TIMESTAMP))) / 3600, 6) + 0.0 AS age_hours,
       (epoch(TIMESTAMP '2002-01-01') - epoch(CAST(max(date) AS TIMESTAMP))) / 3600 > 36 AS stale FROM px""")
def _(spark, folder):
    days = F.datediff(F.col("date"), F.to_date(F.lit("1970-01-01"))) * 86400.0
    return pn.panel_freshness(prices(spark, folder, "p_brand"), days, 1009843200)


@register("partition_coherence", f"""WITH {PX25},
m AS (SELECT strftime(date, '%Y%m') AS ym, count(*) AS n_rows FROM px GROUP BY 1),
e AS (SELECT strftime(unnest(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)), INTERVAL 1 MONTH)), '%Y%m') AS ym FROM px)
SELECT coalesce(m.ym, e.ym) AS ym, coalesce(n_rows, 0) AS n_rows, m.ym IS NOT NULL AS present, e.ym IS NOT NULL AS expected
FROM m FULL OUTER JOIN e ON m.ym = e.ym""")
def _(spark, folder):
    return pn.partition_coherence(prices(spark, folder, "p_brand"))


@register("month_cutoffs", f"WITH {PX} SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS month_start FROM px")
def _(spark, folder):
    return pn.month_cutoffs(prices(spark, folder))


@register("year_month_key", f"WITH {PX} SELECT strftime(date, '%Y%m') AS ym, count(*) AS n_rows FROM px GROUP BY 1")
def _(spark, folder):
    from loomwork.functions.clock import year_month

    return prices(spark, folder).groupBy(year_month("date").alias("ym")).agg(F.count("*").alias("n_rows"))


# --- features --------------------------------------------------------------

@register("safe_pct_change", select_sql(f"{DENSE25},\n{ret_sql()}", "rets", "date asset", "ret"))
def _(spark, folder):
    return ft.safe_pct_change(dense(spark, folder, "p_brand"), 1)


@register("momentum_features", select_sql(FEAT, "feats0", "date asset", "mom_1m mom_3m mom_6m"))
def _(spark, folder):
    return ft.momentum_features(dense(spark, folder))


@register("realised_vol_20", select_sql(FEAT, "feats0", "date asset", "vol_20"))
def _(spark, folder):
    return ft.realised_vol_20(dense(spark, folder))


@register("reversal_5", select_sql(FEAT, "feats0", "date asset", "rev_5"))
def _(spark, folder):
    return ft.reversal_5(dense(spark, folder))


@register("next_day_target", select_sql(FEAT, "feats", "date asset", "target"))
def _(spark, folder):
    return ft.next_day_target(dense(spark, folder))


@register("build_features", select_sql(FEAT, "feats", "date asset", FEATURE_COLS + " target"))
def _(spark, folder):
    return ft.build_features(dense(spark, folder))


@register("align_features_target", select_sql(FEAT, "feats", "date asset", "mom_1m mom_3m mom_6m target"))
def _(spark, folder):
    panel = dense(spark, folder)
    return ft.align_features_target(ft.momentum_features(panel), ft.next_day_target(panel))


@register("forward_returns", select_sql(f"""{DENSE},
fwd AS (SELECT date, asset, lead(close, 5) OVER (PARTITION BY asset ORDER BY date) / nullif(close, 0) - 1 AS fwd_ret FROM dense)""",
          "fwd", "date asset", "fwd_ret"))
def _(spark, folder):
    return ft.forward_returns(dense(spark, folder), 5)


@register("expected_alpha", select_sql(f"{DENSE25},\n{alpha_sql()}", "alphas", "date asset", "alpha"))
def _(spark, folder):
    return ft.expected_alpha(dense(spark, folder, "p_brand"))


@register("ts_cv_folds", select_sql(f"""{FEAT},
n AS (SELECT date, asset, row_number() OVER (ORDER BY date, asset) - 1 AS row, count(*) OVER () AS total FROM feats),
f AS (SELECT n.*, fold, total - (4 - fold) * (total // 4) AS start FROM n CROSS JOIN (SELECT unnest([1, 2, 3]) AS fold) k),
g AS (SELECT date, asset, row, fold, CASE WHEN row < start THEN 'train' WHEN row < start + total // 4 THEN 'test' END AS role FROM f)""",
          "g", "date asset role", "", "row fold", tail="WHERE role IS NOT NULL"))
def _(spark, folder):
    return ft.ts_cv_folds(ft.build_features(dense(spark, folder)).select("date", "asset"))


@register("r2_by_fold", select_sql(f"""{FEAT},
n AS (SELECT mom_1m / 20 AS pred, target, row_number() OVER (ORDER BY date, asset) - 1 AS row, count(*) OVER () AS total FROM feats),
f AS (SELECT n.*, fold, total - (4 - fold) * (total // 4) AS start FROM n CROSS JOIN (SELECT unnest([1, 2, 3]) AS fold) k),
t AS (SELECT fold, pred, target FROM f WHERE row >= start AND row < start + total // 4),
m AS (SELECT fold, avg(target) AS mean FROM t GROUP BY 1),
r AS (SELECT t.fold, 1 - sum((target - pred) * (target - pred)) / sum((target - mean) * (target - mean)) AS r2, count(*) AS n
      FROM t JOIN m ON m.fold = t.fold GROUP BY 1)""", "r", "", "r2", "fold n"))
def _(spark, folder):
    """Fit of 1/20 of the one-month momentum as a forecast, per test fold."""
    from loomwork.operators.models import r2_by_fold

    rows = ft.build_features(dense(spark, folder)).select("date", "asset", (F.col("mom_1m") / 20).alias("prediction"), "target")
    tests = ft.ts_cv_folds(rows).filter("role = 'test'")
    return r2_by_fold(tests)


SUPPLIERS = prices_sql("l_suppkey")


@register("expected_panel_build", select_sql(f"{SUPPLIERS},\n{dense_sql()},\n{alpha_sql()}", "alphas", "date asset", "alpha"))
def _(spark, folder):
    """The alpha panel of all suppliers: as many cells as suppliers × trading days."""
    return ft.expected_alpha(pn.dense_panel(cut_lineage(supplier_prices(spark, folder))))

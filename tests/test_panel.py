"""Panels, features, weights, backtest and gates on small literals."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomwork.operators import backtest as bt
from loomwork.operators import features as ft
from loomwork.operators import gates
from loomwork.operators import panel as pn
from loomwork.operators import portfolio as pf
from loomwork.operators import stats

DAY = dt.date(2020, 1, 1)


def day(i):
    return DAY + dt.timedelta(days=i)


def panel(spark, rows):
    return spark.createDataFrame([(day(d), a, c) for d, a, c in rows], "date date, asset string, close double")


def series(spark, values):
    return spark.createDataFrame([(day(i), float(v)) for i, v in enumerate(values)], "date date, ret double")


def cells(df, value):
    return {(r["date"], r["asset"]): r[value] for r in df.collect()}


def test_gaps_are_filled_forward_only(spark):
    got = cells(pn.dense_panel(panel(spark, [(0, "a", 1.0), (2, "a", 3.0), (1, "b", 5.0)])), "close")
    assert got == {(day(0), "a"): 1.0, (day(1), "a"): 1.0, (day(2), "a"): 3.0, (day(0), "b"): None, (day(1), "b"): 5.0, (day(2), "b"): 5.0}


def test_asof_fills_leading_gaps_backwards(spark):
    days = spark.createDataFrame([(day(0),), (day(3),)], "date date")
    rows = panel(spark, [(1, "a", 1.0), (2, "a", 2.0), (4, "a", 9.0)])
    got = cells(pn.asof_align(rows.union(panel(spark, [(0, "b", 7.0)])), days), "close")
    # on day 3 the last earlier value is that of day 2, though day 2 is not on the calendar
    assert got[(day(3), "a")] == 2.0 and got[(day(0), "b")] == 7.0
    # nothing on or before day 0: the first later calendar value
    assert got[(day(0), "a")] == 2.0


def test_on_calendar_ignores_values_between_its_dates(spark):
    days = spark.createDataFrame([(day(0),), (day(3),)], "date date")
    got = cells(pn.on_calendar(panel(spark, [(2, "a", 2.0), (3, "a", 4.0)]), days), "close")
    assert got == {(day(0), "a"): 4.0, (day(3), "a"): 4.0}


def test_zero_price_gives_zero_return(spark):
    got = cells(ft.safe_pct_change(panel(spark, [(0, "a", 0.0), (1, "a", 5.0), (2, "a", 10.0)])), "ret")
    assert list(got.values()) == [0.0, 0.0, 1.0]


def test_features_against_pandas(spark):
    rng = np.random.default_rng(5)
    close = pd.Series(100 * np.cumprod(1 + rng.normal(0, 0.02, 200)))
    df = panel(spark, [(i, "a", float(c)) for i, c in enumerate(close)])
    got = ft.build_features(df).toPandas().sort_values("date")
    r1 = close.pct_change().fillna(0)
    want = pd.DataFrame({
        "mom_1m": close.pct_change(20).fillna(0), "mom_3m": close.pct_change(63).fillna(0), "mom_6m": close.pct_change(126).fillna(0),
        "vol_20": r1.rolling(20).std().fillna(0), "rev_5": -close.pct_change(5).fillna(0), "target": r1.shift(-1),
    }).dropna()
    assert len(got) == 199
    assert np.allclose(got[list(want)].to_numpy(), want.to_numpy())
    raw = close.pct_change()
    alpha = (0.4 * raw.rolling(20).mean() + 0.3 * raw.rolling(63).mean() + 0.3 * raw.rolling(126).mean()).fillna(0)
    assert np.allclose(ft.expected_alpha(df).toPandas().sort_values("date")["alpha"], alpha)


def test_ragged_arrays(spark):
    arrays = spark.createDataFrame([("a", [1.0, None, 3.0]), ("b", [None, 2.0])], "asset string, prices array<double>")
    got = {(r["asset"], r["step"]): r["close"] for r in pn.ragged_to_panel(arrays).collect()}
    assert got == {("a", 0): 1.0, ("a", 1): 1.0, ("a", 2): 3.0, ("b", 0): 2.0, ("b", 1): 2.0, ("b", 2): 2.0}


def test_later_slice_wins(spark):
    old, new = panel(spark, [(0, "a", 1.0), (1, "a", 2.0)]), panel(spark, [(1, "a", 9.0)])
    assert cells(pn.upsert(old, new), "close") == {(day(0), "a"): 1.0, (day(1), "a"): 9.0}


def test_unknown_ticker_is_an_error(spark):
    with pytest.raises(ValueError):
        pn.date_range(panel(spark, [(0, "a", 1.0)]), "zzz")


def test_folds_expand_in_time(spark):
    rows = panel(spark, [(d, a, 0.0) for d in range(5) for a in "ab"]).drop("close")
    got = ft.ts_cv_folds(rows).toPandas()
    sizes = got.groupby(["fold", "role"]).size().to_dict()
    assert sizes == {(1, "train"): 4, (1, "test"): 2, (2, "train"): 6, (2, "test"): 2, (3, "train"): 8, (3, "test"): 2}


def test_weights_meet_net_and_gross(spark):
    raw = spark.createDataFrame([(DAY, a, w) for a, w in zip("abcd", [3.0, -0.1, -0.2, 0.05])], "date date, asset string, w double")
    w = pf.signal_weights(raw, 0.5, 0.6).toPandas()["w"]
    assert abs(w.sum()) < 1e-12 and w.abs().sum() <= 0.6 + 1e-9


def test_sector_is_the_hash_of_the_name(spark):
    import hashlib

    names = ["AAPL", "SIM0001", "x", ""]
    rows = spark.createDataFrame([(n,) for n in names], "asset string")
    got = {r["asset"]: r["sector"] for r in pf.sha1_sector(rows).collect()}
    assert got == {n: pf.SECTORS[int(hashlib.sha1(n.encode()).hexdigest(), 16) % 11] for n in names}


@pytest.mark.parametrize("block,span", [(2, 366), (100, 366), (2, 7), (100, 1)])
def test_covariance_blocks(spark, block, span):
    """Pairwise-complete covariance against pandas, with one or many asset blocks and date spans."""
    rng = np.random.default_rng(2)
    wide = pd.DataFrame(rng.normal(0, 0.02, (90, 5)), columns=list("abcde"), index=[day(i) for i in range(90)])
    holes = wide.mask(rng.random(wide.shape) < 0.2)
    long = lambda w: w.rename_axis("date").reset_index().melt("date", var_name="asset", value_name="ret").dropna()
    got = pf.cov_ridge(spark.createDataFrame(long(holes)).withColumn("date", F.to_date("date")), 1e-6, block, span).toPandas()
    want = holes.cov()
    assert len(got) == 15
    for r in got.itertuples():
        assert r.cov == pytest.approx(want.loc[r.asset_a, r.asset_b] + (1e-6 if r.asset_a == r.asset_b else 0), abs=1e-12)
    rolled = pf.rolling_cov(spark.createDataFrame(long(wide)).withColumn("date", F.to_date("date")), 60, block, span).toPandas()
    assert len(rolled) == 31 * 15
    for r in rolled.sample(40, random_state=1).itertuples():
        window = wide.loc[:r.date].tail(60)
        assert r.cov == pytest.approx(window[r.asset_a].cov(window[r.asset_b]), abs=1e-12)
    last = rolled[rolled["date"] == day(89)]
    want = wide.tail(60).cov()
    for r in last.itertuples():
        assert r.cov == pytest.approx(want.loc[r.asset_a, r.asset_b], abs=1e-12)


def test_one_date_gives_the_identity(spark):
    rows = spark.createDataFrame([(DAY, "a", 0.1), (DAY, "b", 0.2)], "date date, asset string, ret double")
    assert {(r["asset_a"], r["asset_b"]): r["cov"] for r in pf.cov_ridge(rows).collect()} == {("a", "a"): 1.0, ("a", "b"): 0.0, ("b", "b"): 1.0}


def test_first_day_has_no_cost_and_weights_earn_the_next_day(spark):
    prices = panel(spark, [(0, "a", 100.0), (1, "a", 110.0), (2, "a", 99.0)])
    weights = spark.createDataFrame([(day(0), "a", 1.0), (day(1), "a", 0.5)], "date date, asset string, w double")
    got = [r["ret"] for r in bt.strategy_returns(bt.book(prices, weights), 100.0).orderBy("date").collect()]
    assert got == pytest.approx([0.0, 0.1 - 0.005, 0.5 * -0.1 - 0.005])


def test_summary_rules(spark):
    got = bt.backtest_summary(series(spark, [-0.1, 0.1, -0.05])).first()
    cum = np.cumprod([0.9, 1.1, 0.95])
    assert got["cagr"] == pytest.approx(cum[-1] - 1)  # less than a year counts as one
    assert got["max_drawdown"] == pytest.approx(-0.05)  # a loss on the first day is no fall from a high
    r = np.array([-0.1, 0.1, -0.05])
    assert got["sharpe"] == pytest.approx(r.mean() * 252 / (r.std() * math.sqrt(252)))
    assert bt.backtest_summary(series(spark, [0.0, 0.0])).first()["sharpe"] == 0.0


def test_statistics_of_a_short_series(spark):
    assert stats.chunked_sharpe_pbo(series(spark, range(10))).first()["pbo"] == 0.0
    assert stats.newey_west_sharpe_ci(series(spark, [0.1])).first()["sharpe"] == 0.0
    assert stats.block_bootstrap_sharpe(series(spark, [0.1] * 5), 10).first()["lower"] == 0.0


def test_bootstrap_brackets_the_sharpe(spark):
    r = np.random.default_rng(0).normal(0.001, 0.01, 500)
    got = stats.block_bootstrap_sharpe(series(spark, r), 500).first()
    assert got["replicas"] == 500 and got["lower"] < r.mean() / r.std(ddof=1) * math.sqrt(252) < got["upper"]


def test_gate(spark):
    metrics = spark.createDataFrame([("sharpe_annual", 0.5), ("max_dd", -0.4)], "metric string, value double")
    limits = {"dev": {"sharpe_annual": ("min", 0.0), "max_dd": ("max", 0.5)}, "prod": {"sharpe_annual": ("min", 1.0), "max_dd": ("max", 0.2), "vol": ("max", 1.0)}}
    got = {r["profile"]: r for r in gates.threshold_gate(metrics, gates.limits_table(spark, limits)).collect()}
    assert got["dev"]["status"] == "PASSED" and got["dev"]["missing"] == ""
    assert got["prod"]["status"] == "FAILED" and got["prod"]["violations"] == "max_dd,sharpe_annual" and got["prod"]["missing"] == "vol"


def test_nested_metrics(spark):
    rows = spark.createDataFrame([(1, '{"a": {"b": 2.5}, "c": "x"}'), (2, "not json")], "run int, doc string")
    got = gates.flatten_metrics_json(rows, "doc", ["a.b", "c", "d"], ["run"]).collect()
    assert [tuple(r) for r in got] == [(1, "a.b", 2.5)]


def test_diff_and_missing(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "metric string, value double")
    b = spark.createDataFrame([("x", 1.0), ("z", 3.0)], "metric string, value double")
    assert {r["metric"] for r in gates.metric_diff(a, b).collect()} == {"y", "z"}
    assert [r["metric"] for r in gates.missing_required_metrics(a, b.select("metric")).collect()] == ["z"]


def test_long_to_wide_takes_every_given_name(spark):
    from loomwork.operators import panel as pn

    rows = [("2020-01-01", "Brand#1", 1.0), ("2020-01-01", "Brand#99", 2.0), ("2020-01-02", "Brand#99", 3.0)]
    df = spark.createDataFrame(rows, "date string, asset string, close double")
    wide = pn.long_to_wide(df, ["Brand#1", "Brand#99", "Brand#7"]).orderBy("date").collect()
    assert [tuple(r) for r in wide] == [("2020-01-01", 1.0, 2.0, None), ("2020-01-02", None, 3.0, None)]


def test_upsert_rewrites_only_touched_months(spark, tmp_path):
    import os

    from loomwork.sources.files import upsert_months, write_month_partitions

    old = spark.createDataFrame([("2020-01-05", "a", 1.0), ("2020-02-05", "a", 2.0), ("2020-03-05", "a", 3.0)], "date string, asset string, close double")
    old = old.withColumn("date", F.to_date("date"))
    new = spark.createDataFrame([("2020-02-05", "a", 20.0), ("2020-02-06", "a", 21.0)], "date string, asset string, close double").withColumn("date", F.to_date("date"))
    path = str(tmp_path / "bars")
    write_month_partitions(old, path)

    def files(month):
        folder = f"{path}/ym={month}"
        return sorted((f, os.stat(f"{folder}/{f}").st_mtime_ns) for f in os.listdir(folder) if f.endswith(".parquet"))

    jan, mar = files("202001"), files("202003")
    for _ in range(2):  # the same batch twice gives the same table
        got = sorted((str(r["date"]), r["close"]) for r in upsert_months(spark, path, new).collect())
        assert got == [("2020-01-05", 1.0), ("2020-02-05", 20.0), ("2020-02-06", 21.0), ("2020-03-05", 3.0)]
    assert files("202001") == jan and files("202003") == mar


def test_asof_exposures_take_the_latest_loading(spark):
    w = spark.createDataFrame([("2020-01-01", "a", 1.0), ("2020-01-05", "a", 1.0), ("2020-01-10", "a", 2.0), ("2020-01-10", "b", 1.0)],
                              "date string, asset string, w double").withColumn("date", F.to_date("date"))
    loads = spark.createDataFrame([
        (None, "S", "a", 1.0), ("2020-01-03", "B", "a", 0.5), ("2020-01-10", "B", "a", 0.7), ("2020-01-10", "B", "a", 0.9), ("2020-01-20", "B", "b", 3.0),
    ], "date string, factor string, asset string, loading double").withColumn("date", F.to_date("date"))
    got = {(str(r["date"]), r["factor"]): r["exposure"] for r in pf.asof_exposures(w, loads).collect()}
    assert got == {("2020-01-01", "S"): 1.0, ("2020-01-05", "S"): 1.0, ("2020-01-10", "S"): 2.0,
                   ("2020-01-01", "B"): None, ("2020-01-05", "B"): 0.5, ("2020-01-10", "B"): 1.8}

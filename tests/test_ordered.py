"""Running totals, trailing sums and quantiles over several slices and hot keys, against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomwork.operators.curves import score_counts
from loomwork.operators.ordered import exact_quantiles, running_totals, trailing_sums
from loomwork.operators.transactions import velocity_1h


def hot_rows(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.4, 7, rng.integers(0, 50, n))
    time = np.where(rng.random(n) < 0.3, 5000.0, np.round(rng.random(n) * 20000, 1))
    return pd.DataFrame({"id": np.arange(n), "user_id": key, "time_s": time, "amount": np.round(rng.random(n) * 100, 2)})


def test_running_totals_cross_slices(many_slices):
    rows = hot_rows()
    df = many_slices.createDataFrame(rows)
    got = running_totals(df, ["time_s", "id"], {"n": F.lit(1), "spent": F.col("amount").cast("decimal(38,6)")}).toPandas().sort_values(["time_s", "id"])
    assert got["n"].tolist() == list(range(1, len(rows) + 1))
    assert np.allclose(got["spent"].astype(float), rows.sort_values(["time_s", "id"])["amount"].cumsum())


def test_running_totals_per_hot_key(many_slices):
    rows = hot_rows()
    got = running_totals(many_slices.createDataFrame(rows), ["time_s", "id"], {"n": F.lit(1)}, by=["user_id"]).toPandas().set_index("id")["n"]
    want = rows.sort_values(["time_s", "id"]).groupby("user_id").cumcount() + 1
    assert (got.sort_index() == want.sort_index()).all()


def test_slices_are_really_several(many_slices):
    df = many_slices.createDataFrame(hot_rows()).repartitionByRange("time_s", "id").select(F.spark_partition_id().alias("p"))
    assert df.distinct().count() > 4


def brute(rows, user):
    out = {}
    for r in rows.itertuples():
        same = rows[rows["user_id"] == r.user_id] if user else rows
        before = (same["time_s"] < r.time_s) | ((same["time_s"] == r.time_s) & (same["id"] < r.id))
        hit = same[before & (same["time_s"] >= r.time_s - 3600)]
        out[r.id] = (len(hit), round(hit["amount"].sum(), 4))
    return out


def test_trailing_sums_with_ties_and_hot_keys(many_slices):
    rows = hot_rows(600, seed=3)
    df = many_slices.createDataFrame(rows)
    for user in (False, True):
        got = trailing_sums(df, "time_s", "id", "amount", 3600.0, by=["user_id"] if user else []).toPandas()
        assert {r.id: (r.trailing_count, round(r.trailing_sum, 4)) for r in got.itertuples()} == brute(rows, user)


def test_velocity_bounds_are_half_open(spark):
    df = spark.createDataFrame([(0, 0.0, 5.0), (1, 3600.0, 7.0), (2, 3600.0, 1.0), (3, 7200.5, 2.0)], "id bigint, time_s double, amount double")
    got = {r["id"]: (r["velocity_count_1h"], r["velocity_amount_1h"]) for r in velocity_1h(df).collect()}
    # exactly an hour ago counts; an equal time counts for the higher id only
    assert got == {0: (0, 0.0), 1: (1, 5.0), 2: (2, 12.0), 3: (0, 0.0)}


def test_exact_quantiles(many_slices):
    rows = hot_rows(2001)
    points = [0.0, 0.25, 0.5, 0.95, 1.0]
    df = many_slices.createDataFrame(rows)
    got = {r["q"]: r["value"] for r in exact_quantiles(df, "amount", points).collect()}
    assert np.allclose([got[q] for q in points], np.quantile(rows["amount"], points))
    grouped = exact_quantiles(df, "amount", points, by=["user_id"]).toPandas()
    for user, part in grouped.groupby("user_id"):
        assert np.allclose(part.sort_values("q")["value"], np.quantile(rows[rows["user_id"] == user]["amount"], points))


def test_weighted_quantiles(spark):
    df = spark.createDataFrame([(1.0, 3), (5.0, 1)], "x double, n int")
    assert exact_quantiles(df, "x", [0.5, 1.0], weight="n").orderBy("q").toPandas()["value"].tolist() == [1.0, 5.0]


def test_curve_counts_of_one_dominant_model(many_slices):
    rng = np.random.default_rng(0)
    rows = pd.DataFrame({"model": np.where(rng.random(4000) < 0.9, "a", "b"), "score": np.round(rng.random(4000), 3), "label": rng.integers(0, 2, 4000)})
    got = score_counts(many_slices.createDataFrame(rows)).toPandas()
    for r in got.sample(40, random_state=0).itertuples():
        part = rows[(rows["model"] == r.model) & (rows["score"] >= r.threshold)]
        assert (r.tp, r.fp) == (part["label"].sum(), (1 - part["label"]).sum())


@pytest.mark.parametrize("by", [[], ["user_id"]])
def test_rows_with_equal_ids_stay_apart(spark, by):
    rows = [(1, 0.0, 1.00000005, 7), (1, 0.0, 2.0, 8), (1, 10.0, 4.0, 7), (2, 10.0, 8.0, 7), (2, 10.0, 8.0, 7)]
    df = spark.createDataFrame(rows, "id long, time_s double, amount double, user_id long")
    got = trailing_sums(df, "time_s", "id", "amount", 3600.0, by=by, digits=9).collect()
    assert sorted((r.id, r.time_s, r.amount, r.user_id) for r in got) == sorted(rows)
    last = sorted((r.trailing_count, r.trailing_sum) for r in got if r.id == 2)
    assert last == ([(2, 5.00000005), (3, 13.00000005)] if by else [(3, 7.00000005), (4, 15.00000005)])


def test_bootstrap_replicas_differ(spark):
    starts = spark.range(10000).selectExpr("id AS replica", "explode(sequence(0, 4)) AS slot").selectExpr(
        "replica", "conv(substring(md5(concat_ws(',', replica, slot)), 1, 12), 16, 10) % 2480 AS start").groupBy("replica").agg(
        F.collect_list("start").alias("starts"))
    assert starts.select("starts").distinct().count() == 10000


def test_kde_of_several_columns_equals_full_sums(spark):
    import numpy as np

    from loomwork.operators.explore import kde_by_class_columns

    rng = np.random.default_rng(2)
    rows = [(int(c), float(a), float(b) if i % 7 else None) for i, (c, a, b) in enumerate(zip(rng.integers(0, 2, 400), rng.normal(0, 1, 400), rng.exponential(3, 400)))]
    rows += [(2, 1.0, 1.0), (2, 1.0, 1.0)]  # a class without spread has no grid
    df = spark.createDataFrame(rows, "class int, a double, b double")
    got = {(r["column"], r["class"], r["point"]): (r["grid_x"], r["density"]) for r in kde_by_class_columns(df, ["a", "b"], points=200).collect()}
    assert len(got) == 2 * 2 * 200
    for col, idx in (("a", 1), ("b", 2)):
        for c in (0, 1):
            x = np.array([r[idx] for r in rows if r[0] == c and r[idx] is not None])
            n, h = len(x), x.std(ddof=1) * len(x) ** -0.2
            lo, rng_ = x.min(), x.max() - x.min()
            for p in range(200):
                gx = lo - rng_ * 0.5 + p * (rng_ * 2.0 / 199)
                want = np.exp(-0.5 * ((gx - x) / h) ** 2).sum() / np.sqrt(2 * np.pi) / (n * h)
                assert got[(col, c, p)][0] == pytest.approx(gx, rel=1e-12, abs=1e-12)
                assert got[(col, c, p)][1] == pytest.approx(want, rel=1e-9, abs=1e-15)


def test_sized_bounds_bytes_as_well_as_rows(spark):
    from loomwork.session import sized

    narrow = sized(spark.range(10))
    wide = sized(spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("pad")), size=5_000)
    assert "broadcast" in narrow._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in wide._jdf.queryExecution().logical().toString().lower()

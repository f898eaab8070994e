"""Transaction features and descriptive tables over the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.operators import explore as ex
from loomwork.operators import transactions as tx
from loomwork.plans.registry import register, select_sql
from loomwork.sources.derived import TXN_SQL, table, transactions

HOUR = "CAST(((floor(time_s / 3600) % 24) + 24) % 24 AS BIGINT)"
DAY = "CAST(((floor(time_s / 86400) % 7) + 7) % 7 AS BIGINT)"
STATS = f"""{TXN_SQL},
stats AS (SELECT {HOUR} AS hour, avg(amount) AS amount_mean,
          CASE WHEN stddev_samp(amount) = 0 THEN 1 ELSE stddev_samp(amount) END AS amount_std FROM txn GROUP BY 1)"""
Z = f"""{STATS},
zed AS (SELECT t.*, {HOUR} AS hour, (amount - amount_mean) / amount_std AS amount_z_hour FROM txn t LEFT JOIN stats s ON s.hour = {HOUR})"""


def _velocity_sql(user):
    same = "AND b.user_id = a.user_id" if user else ""
    return f"""vel AS (SELECT a.id, count(b.id) AS velocity_count_1h, coalesce(sum(b.amount), 0) AS velocity_amount_1h
  FROM txn a LEFT JOIN txn b ON b.time_s >= a.time_s - 3600.0::DOUBLE AND b.time_s <= a.time_s
       AND (b.time_s < a.time_s OR b.id < a.id) {same} GROUP BY 1)"""


def minute_ties(spark, folder):
    """The transactions with times cut to the minute, so that many are equal."""
    return transactions(spark, folder).withColumn("time_s", F.floor(F.col("time_s") / 60).cast("double") * 60.0)


TIED = TXN_SQL.replace("moment - (SELECT min(moment) FROM ev) AS time_s", "floor((moment - (SELECT min(moment) FROM ev)) / 60) * 60.0::DOUBLE AS time_s")


@register("amount_log", select_sql(f"{TXN_SQL}, o AS (SELECT id, ln(1 + greatest(amount, 0)) AS amount_log FROM txn)", "o", "", "amount_log", "id"))
def _(spark, folder):
    return tx.amount_log(transactions(spark, folder)).select("id", "amount_log")


@register("time_features", select_sql(f"{TXN_SQL}, o AS (SELECT id, {HOUR} AS hour, {DAY} AS day FROM txn)", "o", "", "", "id hour day"))
def _(spark, folder):
    return tx.time_features(transactions(spark, folder)).select("id", "hour", "day")


@register("interactions", select_sql(f"{TXN_SQL}, o AS (SELECT id, v1 * v2 AS v1_v2, v3 * v4 AS v3_v4, v1 * v3 AS v1_v3 FROM txn)", "o", "", "v1_v2 v3_v4 v1_v3", "id"))
def _(spark, folder):
    return tx.interactions(transactions(spark, folder)).select("id", "v1_v2", "v3_v4", "v1_v3")


@register("hour_stats", select_sql(STATS, "stats", "", "amount_mean amount_std", "hour"))
def _(spark, folder):
    return tx.hour_stats(transactions(spark, folder))


@register("hour_stats_join", select_sql(f"""{TXN_SQL},
stats AS (SELECT {HOUR} AS hour, avg(amount) AS m, CASE WHEN stddev_samp(amount) = 0 THEN 1 ELSE stddev_samp(amount) END AS s FROM txn WHERE class = 0 GROUP BY 1),
o AS (SELECT id, (amount - m) / s AS amount_z_hour FROM txn LEFT JOIN stats ON hour = {HOUR})""", "o", "", "amount_z_hour", "id"))
def _(spark, folder):
    """Statistics of the legitimate rows applied to all rows."""
    txn = transactions(spark, folder)
    return tx.hour_stats_join(txn, tx.hour_stats(txn.filter("class = 0"))).select("id", "amount_z_hour")


@register("amount_z_by_hour", select_sql(Z, "zed", "", "amount_z_hour", "id hour"))
def _(spark, folder):
    return tx.amount_z_by_hour(transactions(spark, folder)).select("id", "hour", "amount_z_hour")


@register("velocity_1h", select_sql(f"{TIED}, {_velocity_sql(False)}", "vel", "", "velocity_amount_1h", "id velocity_count_1h"))
def _(spark, folder):
    return tx.velocity_1h(minute_ties(spark, folder)).select("id", "velocity_count_1h", "velocity_amount_1h")


@register("velocity_1h_by_user", select_sql(f"{TIED}, {_velocity_sql(True)}", "vel", "", "velocity_amount_1h", "id velocity_count_1h"))
def _(spark, folder):
    return tx.velocity_1h_by_user(minute_ties(spark, folder)).select("id", "velocity_count_1h", "velocity_amount_1h")


@register("engineer_features", select_sql(f"""{Z}, {_velocity_sql(False)},
o AS (SELECT z.*, {DAY} AS day, ln(1 + greatest(amount, 0)) AS amount_log, v1 * v2 AS v1_v2, v3 * v4 AS v3_v4, v1 * v3 AS v1_v3,
      velocity_count_1h, velocity_amount_1h FROM zed z JOIN vel v ON v.id = z.id)""", "o", "",
          "time_s amount v1 v2 v3 v4 amount_log v1_v2 v3_v4 v1_v3 amount_z_hour velocity_amount_1h", "id user_id class hour day velocity_count_1h"))
def _(spark, folder):
    return tx.engineer_features(transactions(spark, folder))


@register("standard_scale", select_sql(f"""{TXN_SQL},
f AS (SELECT avg(amount) AS ma, stddev_pop(amount) AS sa, avg(time_s) AS mt, stddev_pop(time_s) AS st FROM txn),
o AS (SELECT id, (amount - ma) / sa AS amount, (time_s - mt) / st AS time_s FROM txn, f)""", "o", "", "amount time_s", "id"))
def _(spark, folder):
    return tx.standard_scale(transactions(spark, folder), ["amount", "time_s"]).select("id", "amount", "time_s")


@register("score_decision", """SELECT event_id AS id, round(floor(value * 2) / 1000, 4) + 0.0 AS fraud_probability,
CASE WHEN floor(value * 2) / 1000 >= 0.782::DOUBLE THEN 'fraud' ELSE 'legitimate' END AS prediction, 0.782::DOUBLE AS threshold FROM events""")
def _(spark, folder):
    scored = table(spark, folder, "events").select(F.col("event_id").alias("id"), (F.floor(F.col("value") * 2) / 1000).alias("score"))
    return tx.score_decision(scored, 0.782).drop("score")


# --- descriptive ----------------------------------------------------------------

@register("class_balance", select_sql(f"{TXN_SQL}, o AS (SELECT class, count(*) AS n, count(*) / (SELECT count(*) FROM txn) AS share FROM txn GROUP BY 1)", "o", "", "share", "class n"))
def _(spark, folder):
    return ex.class_balance(transactions(spark, folder))


@register("null_count", """SELECT count(*) FILTER (t.doc_id IS NULL) AS doc_id, count(*) FILTER (text IS NULL) AS text,
count(*) FILTER (toxic IS NULL) AS toxic, count(*) FILTER (quality IS NULL) AS quality,
count(*) FILTER (t.doc_id IS NULL) + count(*) FILTER (text IS NULL) + count(*) FILTER (toxic IS NULL) + count(*) FILTER (quality IS NULL) AS total
FROM documents t LEFT JOIN labels l ON l.doc_id = t.doc_id""")
def _(spark, folder):
    """Documents with their labels, which most lack."""
    joined = table(spark, folder, "documents").select("doc_id", "text").join(table(spark, folder, "labels"), "doc_id", "left")
    return ex.null_count(joined)


COLUMNS = ["time_s", "amount", "v1", "v2", "v3", "v4"]


@register("describe_table", "WITH " + TXN_SQL + "\n" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) + 0.0 AS mean, round(stddev_samp({c}), 6) + 0.0 AS std,
    round(min({c}), 6) + 0.0 AS "min", round(max({c}), 6) + 0.0 AS "max", round(quantile_cont({c}, 0.25), 6) + 0.0 AS q25,
    round(quantile_cont({c}, 0.5), 6) + 0.0 AS q50, round(quantile_cont({c}, 0.75), 6) + 0.0 AS q75 FROM txn""" for c in COLUMNS))
def _(spark, folder):
    return ex.describe_table(transactions(spark, folder), COLUMNS)


@register("hist_by_class", select_sql(f"""{TXN_SQL}, e AS (SELECT class, min(amount) AS lo, max(amount) AS hi FROM txn GROUP BY 1),
o AS (SELECT t.class, least(floor((amount - lo) / (hi - lo) * 50), 49) AS bin, count(*) AS n FROM txn t JOIN e ON e.class = t.class GROUP BY 1, 2)""",
          "o", "", "", "class bin n"))
def _(spark, folder):
    return ex.hist_by_class(transactions(spark, folder))


@register("hour_hist_by_class", select_sql(f"{TXN_SQL}, o AS (SELECT class, {HOUR} AS hour, count(*) AS n FROM txn GROUP BY 1, 2)", "o", "", "", "class hour n"))
def _(spark, folder):
    return ex.hour_hist_by_class(transactions(spark, folder))


@register("kde_by_class", select_sql(f"""{TXN_SQL},
s AS (SELECT class, count(*) AS n, stddev_samp(amount) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h, min(amount) AS lo, max(amount) - min(amount) AS range FROM txn GROUP BY 1),
v AS (SELECT class, amount AS x, count(*) AS c FROM txn GROUP BY 1, 2),
g AS (SELECT class, n, h, p.range AS point, lo - s.range * 0.5 + p.range * (s.range * (2.0::DOUBLE / 999)) AS grid_x FROM s, range(1000) p),
o AS (SELECT g.class, point, max(grid_x) AS grid_x, sum(c * exp(((grid_x - x) / h) * ((grid_x - x) / h) * -0.5)) / sqrt(2 * pi()) / max(n * h) AS density
      FROM g JOIN v ON v.class = g.class GROUP BY 1, 2)""", "o", "", "grid_x density", "class point"))
def _(spark, folder):
    return ex.kde_by_class(transactions(spark, folder), "amount")


@register("corr_with_label", "WITH " + TXN_SQL + "\n" + " UNION ALL ".join(f"""SELECT '{c}' AS "column", round(corr({c}, class), 6) + 0.0 AS corr FROM txn""" for c in COLUMNS))
def _(spark, folder):
    return ex.corr_with_label(transactions(spark, folder), COLUMNS)


@register("read_csv_table", select_sql(TXN_SQL, "txn", "", "time_s amount v1 v2 v3 v4", "id user_id class"))
def _(spark, folder):
    """The transactions written as headered CSV and read back with a stated schema."""
    from loomwork.session import fresh_path
    from loomwork.sources.files import read_csv_table

    path = fresh_path(spark, "csv")
    txn = transactions(spark, folder)
    txn.write.option("header", True).csv(path)
    return read_csv_table(spark, path, txn.schema)

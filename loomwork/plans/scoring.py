"""Splits, balancing, model fits and evaluation curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.operators import curves as cv
from loomwork.operators import features as ft
from loomwork.operators import models as ml
from loomwork.operators import panel as pn
from loomwork.operators import transactions as tx
from loomwork.plans.market import FEAT, dense
from loomwork.plans.registry import register, select_sql
from loomwork.sources.derived import SCORE_SQL, TXN_SQL, scores, table, transactions

V = ["v1", "v2", "v3", "v4"]

CURVE = f"""{SCORE_SQL},
cnt AS (SELECT model, score AS threshold, sum(label) AS pos_at, count(*) AS n_at FROM sc GROUP BY 1, 2),
cur AS (SELECT model, threshold, pos_at, n_at - pos_at AS neg_at, sum(pos_at) OVER d AS tp, sum(n_at - pos_at) OVER d AS fp,
        sum(pos_at) OVER m AS n_pos, sum(n_at - pos_at) OVER m AS n_neg FROM cnt
        WINDOW d AS (PARTITION BY model ORDER BY threshold DESC), m AS (PARTITION BY model)),
pr AS (SELECT *, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision, CAST(tp AS DOUBLE) / CAST(n_pos AS DOUBLE) AS recall FROM cur),
tc AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-9::DOUBLE) AS f1,
       CAST(fp AS DOUBLE) / n_neg AS fpr, recall AS tpr, (n_pos - tp) * 88.0 + fp * 10.0 AS cost FROM pr),
best AS (SELECT model, threshold, f1, tp, fp, n_pos, n_neg FROM tc QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold) = 1),
evald AS (SELECT tc.model, sum(pos_at * 1.0::DOUBLE / tc.n_pos * precision) AS pr_auc,
       sum(neg_at * (tc.tp - pos_at / 2.0::DOUBLE)) / max(CAST(tc.n_pos AS DOUBLE) * tc.n_neg) AS roc_auc,
       max(2.0::DOUBLE * b.tp / (b.tp + b.fp + b.n_pos)) AS f1, max(b.threshold) AS threshold FROM tc JOIN best b ON b.model = tc.model GROUP BY 1)"""


def counts(spark, folder):
    return cv.score_counts(scores(spark, folder))


@register("pr_curve", select_sql(CURVE, "tc", "model", "threshold precision recall"))
def _(spark, folder):
    return cv.pr_curve(counts(spark, folder))


@register("threshold_curve", select_sql(CURVE, "tc", "model", "threshold precision recall f1"))
def _(spark, folder):
    return cv.threshold_curve(counts(spark, folder))


@register("roc_curve", select_sql(CURVE, "tc", "model", "threshold fpr tpr"))
def _(spark, folder):
    return cv.roc_curve(counts(spark, folder))


@register("average_precision", select_sql(CURVE, "evald", "model", "pr_auc"))
def _(spark, folder):
    return cv.average_precision(counts(spark, folder))


@register("roc_auc", select_sql(CURVE, "evald", "model", "roc_auc"))
def _(spark, folder):
    return cv.roc_auc(counts(spark, folder))


@register("best_f1_threshold", select_sql(CURVE, "best", "model", "threshold f1"))
def _(spark, folder):
    return cv.best_f1_threshold(counts(spark, folder))


@register("cost_curve", select_sql(CURVE, "tc", "model", "threshold cost"))
def _(spark, folder):
    return cv.cost_curve(counts(spark, folder))


@register("min_cost_threshold", select_sql(f"{CURVE}, o AS (SELECT model, threshold, cost FROM tc QUALIFY row_number() OVER (PARTITION BY model ORDER BY cost, threshold) = 1)", "o", "model", "threshold cost"))
def _(spark, folder):
    return cv.min_cost_threshold(counts(spark, folder))


CONF = f"""{CURVE},
cm AS (SELECT s.model, b.threshold, count(*) FILTER (score < b.threshold AND label = 0) AS tn, count(*) FILTER (score >= b.threshold AND label = 0) AS fp,
       count(*) FILTER (score < b.threshold AND label = 1) AS fn, count(*) FILTER (score >= b.threshold AND label = 1) AS tp
       FROM sc s JOIN best b ON b.model = s.model GROUP BY 1, 2)"""


def confusion(spark, folder):
    scored = scores(spark, folder)
    return cv.confusion_counts(scored, cv.best_f1_threshold(cv.score_counts(scored)))


@register("confusion_counts", select_sql(CONF, "cm", "model", "threshold", "tn fp fn tp"))
def _(spark, folder):
    return confusion(spark, folder)


@register("classification_report", select_sql(f"""{CONF},
side AS (SELECT model, 'negative' AS row, tn AS hit, fn AS fa, fp AS miss FROM cm UNION ALL SELECT model, 'positive', tp, fp, fn FROM cm),
per AS (SELECT model, row, coalesce(hit / nullif(hit + fa, 0), 0) AS precision, coalesce(hit / nullif(hit + miss, 0), 0) AS recall,
        coalesce(2 * hit / nullif(2 * hit + fa + miss, 0), 0) AS f1, hit + miss AS support FROM side),
rep AS (SELECT * FROM per UNION ALL SELECT model, 'macro', avg(precision), avg(recall), avg(f1), sum(support) FROM per GROUP BY 1
        UNION ALL SELECT model, 'weighted', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM per GROUP BY 1)""",
          "rep", "model row", "precision recall f1", "support"))
def _(spark, folder):
    return cv.classification_report(confusion(spark, folder))


@register("evaluate_model", select_sql(CURVE, "evald", "model", "pr_auc roc_auc f1 threshold"))
def _(spark, folder):
    return cv.evaluate_model(counts(spark, folder))


@register("best_model", select_sql(CURVE, "evald", "model", "pr_auc", tail="ORDER BY evald.pr_auc DESC, model LIMIT 1"))
def _(spark, folder):
    return cv.best_model(cv.evaluate_model(counts(spark, folder)))


# --- splitting and balancing ----------------------------------------------------

@register("stratified_split", f"""WITH {TXN_SQL},
h AS (SELECT id, class, ((id % 1000003) * 7919 + 42 * 104729) % 1000003 AS h FROM txn),
r AS (SELECT id, class, row_number() OVER (PARTITION BY class ORDER BY h, id) AS rank, count(*) OVER (PARTITION BY class) AS n FROM h)
SELECT id, CAST(class AS BIGINT) AS class, CASE WHEN rank > n - ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM r""")
def _(spark, folder):
    return ml.stratified_split(transactions(spark, folder).select("id", "class"))


@register("class_weights", select_sql(f"""{TXN_SQL},
c AS (SELECT class, count(*) AS n FROM txn GROUP BY 1), t AS (SELECT sum(n) AS total, count(*) AS k, sum(n) FILTER (class = 1) AS pos FROM c),
o AS (SELECT class, n, total / (k * n) AS weight, (total - pos) / pos AS neg_per_pos FROM c, t)""", "o", "", "weight neg_per_pos", "class n"))
def _(spark, folder):
    return ml.class_weights(transactions(spark, folder))


def _mixed_sql(value, salt):
    return f"((({value}) % 1000003) * 7919 + {salt} * 104729) % 1000003"


_DIST = " + ".join(f"(a.{v} - b.{v}) * (a.{v} - b.{v})" for v in V)


@register("smote", f"""WITH {TXN_SQL},
rare AS (SELECT id, v1, v2, v3, v4 FROM txn WHERE class = 1),
pairs AS (SELECT a.id AS id, b.id AS other, {_DIST} AS d FROM rare a JOIN rare b ON a.id <> b.id),
near AS (SELECT id, other, row_number() OVER (PARTITION BY id ORDER BY d, other) - 1 AS k FROM pairs QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, other) <= 5),
s AS (SELECT count(*) FILTER (class = 1) AS few, count(*) FILTER (class <> 1) AS many FROM txn),
r AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS rank FROM rare),
c AS (SELECT r.id, unnest(range((many - few) // few + CASE WHEN rank < (many - few) % few THEN 1 ELSE 0 END)) AS copy FROM r, s),
p AS (SELECT id, copy, {_mixed_sql('id + copy * 31', 17)} % 5 AS k, ({_mixed_sql('id + copy * 37', 29)} % 10000) / 10000.0::DOUBLE AS u FROM c),
made AS (SELECT p.id, p.copy, {", ".join(f"a.{v} + u * (b.{v} - a.{v}) AS {v}" for v in V)}, 1 AS class
         FROM p JOIN near n ON n.id = p.id AND n.k = p.k JOIN rare a ON a.id = p.id JOIN rare b ON b.id = n.other),
o AS (SELECT id, -1 AS copy, v1, v2, v3, v4, class FROM txn UNION ALL SELECT * FROM made)
SELECT id, CAST(copy AS BIGINT) AS copy, {", ".join(f"round({v}, 6) + 0.0 AS {v}" for v in V)}, CAST(class AS BIGINT) AS class FROM o""")
def _(spark, folder):
    return ml.smote(transactions(spark, folder), V)


# --- fits (checked by row count and, in the tests, by quality) --------------------

FIT_FEATURES = ["v1", "v2", "v3", "v4", "amount", "amount_log", "hour", "day", "v1_v2", "v3_v4", "v1_v3", "amount_z_hour"]


def fit_rows(spark, folder):
    """Model features with hour statistics of the training rows only, and the split."""
    split = ml.stratified_split(transactions(spark, folder))
    stats = tx.hour_stats(split.filter("split = 'train'"))
    return tx.serving_features(split, stats)


def _scored(spark, folder, fit, name):
    rows = fit_rows(spark, folder)
    model = fit(rows.filter("split = 'train'"), FIT_FEATURES)
    return ml.predict_scores(model, rows.filter("split = 'test'"), ["id", F.col("class").alias("label")], name)


@register("fit_logistic")
def _(spark, folder):
    return _scored(spark, folder, ml.fit_logistic, "logistic")


@register("fit_forest")
def _(spark, folder):
    return _scored(spark, folder, ml.fit_forest, "forest")


@register("fit_boosted")
def _(spark, folder):
    return _scored(spark, folder, ml.fit_boosted, "boosted")


@register("random_search_cv")
def _(spark, folder):
    """The whole search: 30 draws from the full grid, three folds each."""
    rows = fit_rows(spark, folder).filter("split = 'train'")
    return ml.random_search_cv(rows, FIT_FEATURES)[0]


def _return_model(spark, folder):
    rows = ft.build_features(dense(spark, folder))
    return ml.fit_return_regressor(ft.ts_cv_folds(rows), ft.FEATURES, trees=10, depth=3)


@register("fit_return_regressor")
def _(spark, folder):
    return _return_model(spark, folder)[1]


@register("predict_alphas")
def _(spark, folder):
    model, _ = _return_model(spark, folder)
    latest = pn.latest_cross_section(ft.build_features(dense(spark, folder)))
    return model.transform(latest).select("date", "asset", F.col("prediction").alias("alpha"))


@register("feature_importance")
def _(spark, folder):
    return ml.feature_importance(_return_model(spark, folder)[0], ft.FEATURES)


_FEATURE_PLACE = list(enumerate(ft.FEATURES))


@register("topk_abs_features", f"""WITH {FEAT},
last AS (SELECT * FROM feats WHERE date = (SELECT max(date) FROM feats)),
asked AS (SELECT DISTINCT p_type AS asset FROM part UNION SELECT DISTINCT p_brand FROM part),
items AS ({" UNION ALL ".join(f"SELECT a.asset, {i} AS place, '{f}' AS feature, coalesce({f}, 0) AS value FROM asked a LEFT JOIN last l ON l.asset = a.asset" for i, f in _FEATURE_PLACE)}),
r AS (SELECT asset, feature, value, row_number() OVER (PARTITION BY asset ORDER BY abs(value) DESC, place) AS rank FROM items)
SELECT asset, CAST(rank AS BIGINT) AS rank, feature, round(value, 6) + 0.0 AS value FROM r WHERE rank <= 3""")
def _(spark, folder):
    """The three largest features of every type and brand; brands have no features here, so they get zeros."""
    parts = table(spark, folder, "part")
    wanted = parts.select(F.col("p_type").alias("asset")).union(parts.select("p_brand"))
    latest = pn.latest_cross_section(ft.build_features(dense(spark, folder)))
    return ml.topk_abs_features(latest.drop("date", "target"), wanted, ft.FEATURES, 3)

"""Precision/recall, ROC, F1 and cost curves from scores ``(model, score, label)``.

Rows are counted per distinct score first. The running counts come from range-sliced totals, and areas are sums
of per-score terms, so no window spans a model's scores and no lag is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.operators.ordered import running_totals
from loomwork.session import sized

FN_COST, FP_COST = 88.0, 10.0  # fixed values: cost of a missed and of a false alarm


def score_counts(scored: DataFrame, by: str = "model") -> DataFrame:
    """Per (model, threshold): rows at the score, rows at or above it, and the totals of the model."""
    counted = scored.groupBy(by, F.col("score").alias("threshold")).agg(
        F.sum(F.col("label").cast("bigint")).alias("pos_at"), F.count("*").alias("n_at")
    ).withColumn("_down", -F.col("threshold"))
    running = running_totals(counted, ["_down"], {"tp": F.col("pos_at"), "flagged": F.col("n_at")}, by=[by])
    totals = running.groupBy(by).agg(F.sum("pos_at").alias("n_pos"), F.sum("n_at").alias("n_all"))
    return running.join(sized(totals), by).select(
        by, "threshold", "pos_at", (F.col("n_at") - F.col("pos_at")).alias("neg_at"), "tp",
        (F.col("flagged") - F.col("tp")).alias("fp"), "n_pos", (F.col("n_all") - F.col("n_pos")).alias("n_neg"),
    )


def _precision():
    return F.col("tp") / (F.col("tp") + F.col("fp"))


def _recall():
    return F.try_divide(F.col("tp"), F.col("n_pos"))


def threshold_curve(counts: DataFrame, by: str = "model") -> DataFrame:
    """Precision, recall and F1 at each distinct score."""
    pr = counts.select(by, "threshold", _precision().alias("precision"), _recall().alias("recall"))
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-9)
    return pr.withColumn("f1", f1)


def pr_curve(counts: DataFrame, by: str = "model") -> DataFrame:
    return threshold_curve(counts, by).drop("f1")


def roc_curve(counts: DataFrame, by: str = "model") -> DataFrame:
    return counts.select(by, "threshold", F.try_divide("fp", "n_neg").alias("fpr"), F.try_divide("tp", "n_pos").alias("tpr"))


def average_precision(counts: DataFrame, by: str = "model") -> DataFrame:
    """Sum over scores of the recall gained there times the precision."""
    return counts.groupBy(by).agg(F.sum(F.try_divide("pos_at", "n_pos") * _precision()).alias("pr_auc"))


def roc_auc(counts: DataFrame, by: str = "model") -> DataFrame:
    """Trapezoid area; a score shared by both classes counts half."""
    area = F.col("neg_at") * (F.col("tp") - F.col("pos_at") / 2.0)
    return counts.groupBy(by).agg(F.try_divide(F.sum(area), F.max(F.col("n_pos").cast("double") * F.col("n_neg"))).alias("roc_auc"))


def best_f1_threshold(counts: DataFrame, by: str = "model") -> DataFrame:
    """Threshold with the highest F1, the lowest one on ties."""
    return threshold_curve(counts, by).groupBy(by).agg(
        F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold"))).alias("b")
    ).select(by, "b.threshold", "b.f1")


def cost_curve(counts: DataFrame, fn_cost: float = FN_COST, fp_cost: float = FP_COST, by: str = "model") -> DataFrame:
    """Cost of missed and false alarms at each distinct score."""
    return counts.select(by, "threshold", ((F.col("n_pos") - F.col("tp")) * fn_cost + F.col("fp") * fp_cost).alias("cost"))


def min_cost_threshold(counts: DataFrame, fn_cost: float = FN_COST, fp_cost: float = FP_COST, by: str = "model") -> DataFrame:
    """Cheapest threshold, the lowest one on ties."""
    return cost_curve(counts, fn_cost, fp_cost, by).groupBy(by).agg(
        F.min_by(F.struct("threshold", "cost"), F.struct("cost", "threshold")).alias("b")
    ).select(by, "b.threshold", "b.cost")


def confusion_counts(scored: DataFrame, thresholds: DataFrame, by: str = "model") -> DataFrame:
    """2×2 counts at one threshold per model."""
    flagged = F.col("score") >= F.col("threshold")
    positive = F.col("label") == 1
    return scored.join(sized(thresholds.select(by, "threshold")), by).groupBy(by, "threshold").agg(
        F.count_if(~flagged & ~positive).alias("tn"), F.count_if(flagged & ~positive).alias("fp"),
        F.count_if(~flagged & positive).alias("fn"), F.count_if(flagged & positive).alias("tp"),
    )


def classification_report(confusion: DataFrame, by: str = "model") -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means."""

    def side(name, hit, false_alarm, missed):
        p = F.coalesce(F.try_divide(hit, hit + false_alarm), F.lit(0.0))
        r = F.coalesce(F.try_divide(hit, hit + missed), F.lit(0.0))
        f1 = F.coalesce(F.try_divide(2 * hit, 2 * hit + false_alarm + missed), F.lit(0.0))
        return F.struct(F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"), f1.alias("f1"), (hit + missed).alias("support"))

    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    both = confusion.select(by, side("negative", tn, fn, fp).alias("a"), side("positive", tp, fp, fn).alias("b"))
    names = ("precision", "recall", "f1")
    total = (F.col("a.support") + F.col("b.support")).alias("support")
    macro = F.struct(F.lit("macro").alias("row"), *[((F.col(f"a.{n}") + F.col(f"b.{n}")) / 2).alias(n) for n in names], total)
    weighted = F.struct(F.lit("weighted").alias("row"), *[
        ((F.col(f"a.{n}") * F.col("a.support") + F.col(f"b.{n}") * F.col("b.support")) / (F.col("a.support") + F.col("b.support"))).alias(n)
        for n in names], total)
    return both.select(by, F.inline(F.array("a", "b", macro, weighted)))


def evaluate_model(counts: DataFrame, by: str = "model") -> DataFrame:
    """One row per model: areas, best-F1 threshold and the F1 of the verdicts there."""
    f1 = 2 * _precision() * _recall() / (_precision() + _recall() + 1e-9)
    plain = 2.0 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("n_pos"))
    area = F.col("neg_at") * (F.col("tp") - F.col("pos_at") / 2.0)
    best = F.max_by(F.struct("threshold", plain.alias("f1")), F.struct(f1, -F.col("threshold")))
    return counts.groupBy(by).agg(
        F.sum(F.try_divide("pos_at", "n_pos") * _precision()).alias("pr_auc"),
        F.try_divide(F.sum(area), F.max(F.col("n_pos").cast("double") * F.col("n_neg"))).alias("roc_auc"),
        best.alias("b"),
    ).select(by, "pr_auc", "roc_auc", "b.f1", "b.threshold")


def best_model(evaluated: DataFrame, by: str = "model") -> DataFrame:
    """Model with the highest precision/recall area; the first name on ties."""
    return evaluated.orderBy(F.desc("pr_auc"), by).limit(1).select(by, "pr_auc")

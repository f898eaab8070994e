"""Splitting, balancing, fitting and checking models on tables with Spark ML."""

from __future__ import annotations

import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.operators import trees as tr
from loomwork.operators.ordered import running_totals
from loomwork.operators.vectors import cell_neighbours
from loomwork.session import sized, stored as kept

# The grid the search draws from.
SEARCH_GRID = {
    "maxIter": [100, 200, 300, 500], "maxDepth": [3, 4, 5, 6, 8], "stepSize": [0.01, 0.05, 0.1, 0.2],
    "subsamplingRate": [0.6, 0.8, 1.0], "featureSubsetStrategy": ["0.6", "0.8", "1.0"], "minInstancesPerNode": [1, 3, 5], "minInfoGain": [0.0, 0.1, 0.3],
}


def mixed(ident: str | Column, salt: int) -> Column:
    """Arithmetic hash in 0 … 1000002, repeatable in any engine."""
    value = F.col(ident) if isinstance(ident, str) else ident
    return F.pmod(F.pmod(value, F.lit(1000003)) * 7919 + salt * 104729, F.lit(1000003))


def stratified_split(df: DataFrame, label: str = "class", ident: str = "id", test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``: of each class, the last ceil(n × test_size) rows in hash order are the test rows."""
    shuffled = df.withColumn("_h", mixed(ident, seed))
    ranked = running_totals(shuffled, ["_h", ident], {"_rank": F.lit(1)}, by=[label])
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    test = F.col("_rank") > F.col("_n") - F.ceil(F.col("_n") * test_size)
    return ranked.join(sized(sizes), label).withColumn("split", F.when(test, F.lit("test")).otherwise(F.lit("train"))).drop("_h", "_rank", "_n")


def smote(df: DataFrame, features: Sequence[str], label: str = "class", ident: str = "id", k: int = 5, minority: int = 1) -> DataFrame:
    """Add minority rows until both classes are equal in number.

    A new row lies between a minority row and one of its ``k`` nearest minority rows (exact, by space cells:
    ``cell_neighbours``). Row, neighbour and position come from ranks and arithmetic hashes, so the result repeats.
    """
    rare = df.filter(F.col(label) == minority).select(F.col(ident).alias("cand_id"), F.array(*[F.col(f).cast("double") for f in features]).alias("v"))
    # exact k nearest other minority rows, searched by space cells: no all-pairs scan
    around = cell_neighbours(rare.select(F.col("cand_id").alias("id"), "v"), k)
    order = F.array_sort(F.collect_list(F.struct("rank", "cand_id")))
    friends = around.groupBy("query_id").agg(F.slice(order, 1, k).alias("near")).select("query_id", F.transform("near", lambda r: r["cand_id"]).alias("near"))
    sizes = df.agg(F.count_if(F.col(label) == minority).alias("few"), F.count_if(F.col(label) != minority).alias("many"))
    ranked = running_totals(rare, ["cand_id"], {"_rank": F.lit(1)}).withColumn("_s", sizes.select(F.struct("few", "many")).scalar())
    need = F.greatest(F.col("_s.many") - F.col("_s.few"), F.lit(0))
    copies = F.floor(need / F.col("_s.few")) + F.when(F.col("_rank") - 1 < need % F.col("_s.few"), F.lit(1)).otherwise(F.lit(0))
    spread = ranked.withColumn("_copies", copies).filter("_copies > 0").select("cand_id", "v", F.explode(F.sequence(F.lit(0), (F.col("_copies") - 1).cast("int"))).alias("copy"))
    pick = mixed(F.col("cand_id") + F.col("copy") * 31, 17)
    chosen = spread.join(friends.withColumnRenamed("query_id", "cand_id"), "cand_id").select(
        F.col("cand_id").alias("base_id"), "v", "copy", F.get("near", (pick % F.size("near")).cast("int")).alias("cand_id"),
        ((mixed(F.col("cand_id") + F.col("copy") * 37, 29) % 10000) / 10000.0).alias("u"),
    )
    made = chosen.join(rare.select("cand_id", F.col("v").alias("to")), "cand_id")
    new = made.select(
        F.col("base_id").alias(ident), F.col("copy").alias("copy"),
        *[(F.get("v", F.lit(i)) + F.col("u") * (F.get("to", F.lit(i)) - F.get("v", F.lit(i)))).alias(f) for i, f in enumerate(features)],
        F.lit(minority).alias(label),
    )
    old = df.select(ident, F.lit(-1).alias("copy"), *[F.col(f).cast("double").alias(f) for f in features], label)
    return old.unionByName(new)


def class_weights(df: DataFrame, label: str = "class") -> DataFrame:
    """Per class: rows, balanced weight n / (classes × n_c), and negatives per positive."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    sums = counts.agg(F.struct(F.sum("n").alias("all"), F.count("*").alias("classes"), F.sum(F.when(F.col(label) == 1, F.col("n"))).alias("pos"))).scalar()
    return counts.withColumn("_s", sums).select(
        label, "n", (F.col("_s.all") / (F.col("_s.classes") * F.col("n"))).alias("weight"),
        F.try_divide(F.col("_s.all") - F.col("_s.pos"), F.col("_s.pos")).alias("neg_per_pos"),
    )


def with_class_weight(df: DataFrame, label: str = "class") -> DataFrame:
    """Attach the balanced weight of each row's class."""
    return df.join(sized(class_weights(df, label).select(label, "weight")), label)


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(df)


def _fit(estimator, train: DataFrame, features: Sequence[str]) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    rows = assembler.transform(train).persist()
    model = estimator.fit(rows)
    rows.unpersist()
    return PipelineModel([assembler, model])


def _search_rows(train: DataFrame, features: Sequence[str], label: str) -> tuple[DataFrame, DataFrame]:
    """(stored, weighted): the vectors and labels, kept once, and these with positives weighted by negatives per positive.

    The ratio is a number counted from the stored rows, so ``train`` is worked out a single time.
    """
    stored = assemble(train, features).select("features", label).persist()
    found = class_weights(stored, label).filter(F.col(label) == 1).select("neg_per_pos").first()
    ratio = F.lit(found[0] if found else None).cast("double")
    return stored, stored.withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def fit_logistic(train: DataFrame, features: Sequence[str], label: str = "class", max_iter: int = 2000) -> PipelineModel:
    """Balanced logistic regression."""
    weighted = with_class_weight(train, label)
    return _fit(LogisticRegression(labelCol=label, weightCol="weight", maxIter=max_iter), weighted, features)


def fit_forest(train: DataFrame, features: Sequence[str], label: str = "class", trees: int = 100, seed: int = 42, depth: int = 30) -> PipelineModel:
    """Balanced random forest; trees grow until they are pure or ``depth`` (Spark's largest by default)."""
    weighted = with_class_weight(train, label)
    return _fit(RandomForestClassifier(labelCol=label, weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed), weighted, features)


def fit_boosted(train: DataFrame, features: Sequence[str], label: str = "class", seed: int = 42, **params) -> PipelineModel:
    """Boosted trees, positives weighted by negatives per positive.

    Up to ``trees.TASK_ROWS`` rows all trees are grown in one task of one job, above that by Spark level by level.
    """
    settings = {"maxIter": 200, "maxDepth": 6, "stepSize": 0.1, "seed": seed, **params}
    rows, weighted = _search_rows(train, features, label)
    if rows.count() <= tr.TASK_ROWS:
        cuts = tr.place_bins(weighted, seed)
        model = tr.boosted(kept(tr.packed(weighted, cuts, label), "binned"), cuts, **settings)
    else:
        model = GBTClassifier(labelCol=label, weightCol="weight", **settings).fit(weighted)
    rows.unpersist()
    return PipelineModel([VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"), model])


def predict_scores(model: PipelineModel, rows: DataFrame, keep: Sequence[str], name: str) -> DataFrame:
    """Positive-class probabilities as ``(model, keep…, score)``."""
    return model.transform(rows).select(F.lit(name).alias("model"), *keep, vector_to_array("probability")[1].alias("score"))


def _search(weighted: DataFrame, label: str, drawn: list[dict], folds: int, seed: int, parallelism: int | None) -> tuple[list[float], Model]:
    """Mean precision/recall area of every setting, and the model of the best one, by fits that share one table of binned rows.

    ``parallelism`` fits run side by side, by default one per core.
    """
    spark = weighted.sparkSession
    cuts = tr.place_bins(weighted, seed)
    blocks = kept(tr.packed(weighted.withColumn("_fold", F.floor(F.rand(seed) * folds)), cuts, label, "_fold"), "binned")
    scorer = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", metricName="areaUnderPR")

    def area(fit: tuple[int, int]) -> float:
        scored = tr.held_out_scores(blocks, cuts, fit[1], seed=seed, **drawn[fit[0]]).persist()
        found = scorer.evaluate(scored)
        scored.unpersist()
        return found

    fits = [(i, fold) for i in range(len(drawn)) for fold in range(folds)]
    fits.sort(key=lambda f: -drawn[f[0]].get("maxIter", 1) * drawn[f[0]].get("maxDepth", 1))  # the longest first
    with ThreadPoolExecutor(parallelism or spark.sparkContext.defaultParallelism) as pool:
        areas = dict(zip(fits, pool.map(inheritable_thread_target(spark)(area), fits)))
    means = [sum(areas[i, fold] for fold in range(folds)) / folds for i in range(len(drawn))]
    return means, tr.boosted(blocks, cuts, seed=seed, **drawn[max(range(len(drawn)), key=lambda i: means[i])])


def random_search_cv(train: DataFrame, features: Sequence[str], label: str = "class", draws: int = 30, folds: int = 3,
                     seed: int = 42, grid: dict | None = None, parallelism: int | None = None) -> tuple[DataFrame, PipelineModel]:
    """Boosted trees at drawn settings, cross-validated on the precision/recall area: (results, best model).

    Up to ``trees.TASK_ROWS`` rows each fit is one task, and the fits run side by side; above that Spark fits them.
    """
    grid = grid or SEARCH_GRID
    stored, weighted = _search_rows(train, features, label)
    rng = random.Random(seed)
    drawn = [{name: rng.choice(values) for name, values in grid.items()} for _ in range(draws)]
    if stored.count() <= tr.TASK_ROWS:
        means, best = _search(weighted, label, drawn, folds, seed, parallelism)
    else:
        trees = GBTClassifier(labelCol=label, weightCol="weight", seed=seed)
        maps = [{getattr(trees, name): value for name, value in one.items()} for one in drawn]
        scorer = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR")
        fitted = CrossValidator(estimator=trees, estimatorParamMaps=maps, evaluator=scorer, numFolds=folds, seed=seed, parallelism=parallelism or 4).fit(weighted)
        means, best = fitted.avgMetrics, fitted.bestModel
    stored.unpersist()
    rows = [(i, *[float(one[n]) for n in grid], float(score)) for i, (one, score) in enumerate(zip(drawn, means))]
    schema = "draw int, " + ", ".join(f"{n} double" for n in grid) + ", pr_auc double"
    table = train.sparkSession.createDataFrame(rows, schema)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return table, PipelineModel([assembler, best])


def fit_return_regressor(folded: DataFrame, features: Sequence[str], target: str = "target", trees: int = 300, depth: int = 5,
                         seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Boosted regression per time-ordered fold; the model of the fold with the best fit, and the fit of each fold."""
    folded = folded.persist()  # every fold and every tree reads these rows again
    folds = [r["fold"] for r in folded.select("fold").distinct().orderBy("fold").collect()]
    best, scores = None, None
    for fold in folds:
        part = folded.filter(F.col("fold") == fold)
        model = _fit(GBTRegressor(labelCol=target, maxIter=trees, maxDepth=depth, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed),
                     part.filter("role = 'train'"), features)
        fit = r2_by_fold(model.transform(part.filter("role = 'test'")), target=target).first()
        if best is None or (fit["r2"] is not None and fit["r2"] > best[0]):
            best = (fit["r2"], model)
        scores = (scores or []) + [(int(fold), fit["r2"], int(fit["n"]))]
    folded.unpersist()
    return best[1], folded.sparkSession.createDataFrame(scores, "fold int, r2 double, n bigint")


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Importance of each feature by name."""
    from pyspark.sql import SparkSession

    values = model.stages[-1].featureImportances.toArray()
    return SparkSession.active().createDataFrame([(n, float(v)) for n, v in zip(features, values)], "feature string, importance double")


def topk_abs_features(rows: DataFrame, wanted: DataFrame, features: Sequence[str], k: int = 5) -> DataFrame:
    """The k features of largest size per wanted asset; an asset without a row gets zeros, so none is empty.

    The few features of a row are sorted inside the row.
    """
    joined = wanted.select("asset").distinct().join(rows, "asset", "left")
    items = F.array(*[F.struct((-F.abs(F.coalesce(F.col(f), F.lit(0.0)))).alias("size"), F.lit(i).alias("place"), F.lit(f).alias("feature"),
                               F.coalesce(F.col(f), F.lit(0.0)).alias("value")) for i, f in enumerate(features)])
    return joined.select("asset", F.posexplode(F.slice(F.array_sort(items), 1, k)).alias("pos", "r")).select(
        "asset", (F.col("pos") + 1).alias("rank"), "r.feature", "r.value"
    )


def r2_by_fold(rows: DataFrame, fold: str = "fold", target: str = "target", prediction: str = "prediction") -> DataFrame:
    """1 − SSE/SST per fold; one pass, the total sum of squares from the variance."""
    error = F.col(target) - F.col(prediction)
    return rows.groupBy(fold).agg(
        (1 - F.sum(error * error) / (F.var_pop(target) * F.count(target))).alias("r2"), F.count("*").alias("n")
    )

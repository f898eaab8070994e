"""Files, splits, balancing, model quality and plan shapes."""

import os

import pytest
from pyspark.sql import functions as F

from loomwork.operators import models as ml
from loomwork.operators import shop
from loomwork.operators import transactions as tx
from loomwork.operators.curves import average_precision, evaluate_model, score_counts
from loomwork.sources import files
from loomwork.sources.derived import table, transactions

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("  two\nlines \n")
    (tmp_path / "sub" / "b.txt").write_bytes(b"bad \xff byte")
    (tmp_path / "c.md").write_text("no")
    got = {r["filename"]: r for r in files.read_text_docs(spark, str(tmp_path)).collect()}
    assert set(got) == {"a.txt", "b.txt"}
    assert got["a.txt"]["content"] == "two\nlines" and got["b.txt"]["content"] == "bad � byte"
    assert got["a.txt"]["file_type"] == "txt" and got["a.txt"]["page"] == 1


def test_csv_with_the_stated_schema(spark, tmp_path):
    names = [f.name for f in files.TRANSACTION_SCHEMA.fields]
    (tmp_path / "t.csv").write_text(",".join(names) + "\n" + ",".join(["1.5"] * 30 + ["1"]) + "\n")
    row = files.read_csv_table(spark, str(tmp_path / "t.csv")).first()
    assert row["Time"] == 1.5 and row["Class"] == 1 and len(row) == 31


def test_monthly_csv_files_by_stem(spark, tmp_path):
    (tmp_path / "returns_202001.csv").write_text("date,ret\n2020-01-02,0.5\n")
    (tmp_path / "returns_202002.csv").write_text("date,ret\n2020-02-03,\n")
    (tmp_path / "other_202002.csv").write_text("date,ret\n2020-02-04,9\n")
    got = files.concat_monthlies(spark, str(tmp_path), "returns", "ret double").orderBy("date").collect()
    assert [(str(r["date"]), r["ret"]) for r in got] == [("2020-01-02", 0.5), ("2020-02-03", None)]


def test_vectors_grow_by_appending(spark, tmp_path):
    path = str(tmp_path / "v")
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], "chunk_id bigint, embedding array<double>")
    files.write_vectors(rows, path)
    files.write_vectors(rows, path)
    assert files.vector_profile(files.read_vectors(spark, path)).first().asDict() == {"dim": 2, "total": 4}
    assert files.storage_profile(spark, path).first()["total_bytes"] > 0


def test_month_folders_are_pruned(spark, tmp_path):
    path = str(tmp_path / "p")
    days = spark.range(90).select(F.expr("date_add(date'2020-01-01', cast(id as int))").alias("date"), F.lit("a").alias("asset"))
    files.write_month_partitions(days, path)
    assert sorted(d for d in os.listdir(path) if d.startswith("ym=")) == ["ym=202001", "ym=202002", "ym=202003"]
    # ym comes back as a number from the folder names
    text = plan(spark.read.parquet(path).filter("ym = 202002"))
    assert "PartitionFilters: [isnotnull(ym" in text


def test_only_read_statements_run(spark):
    spark.range(100).createOrReplaceTempView("numbers")
    rows, error = shop.bounded_sql(spark, "SELECT id FROM numbers;")
    assert error is None and rows.count() == 50
    assert shop.bounded_sql(spark, "DROP VIEW numbers")[0] is None
    assert "nothing_here" in shop.bounded_sql(spark, "SELECT * FROM nothing_here")[1]
    assert shop.bounded_sql(spark, "SELECT FROM WHERE")[1]


@pytest.mark.parametrize("text", [
    "WITH x AS (SELECT 1 AS a) INSERT OVERWRITE DIRECTORY '{out}' USING parquet SELECT * FROM x",
    "FROM range(3) INSERT OVERWRITE DIRECTORY '{out}' USING parquet SELECT *",
    "WITH x AS (SELECT 1 AS a), y AS (WITH z AS (SELECT * FROM x) SELECT * FROM z) FROM y INSERT OVERWRITE DIRECTORY '{out}' USING parquet SELECT *",
    "INSERT INTO numbers VALUES (1)", "CREATE TABLE made AS SELECT 1", "CACHE TABLE numbers", "SET spark.sql.ansi.enabled=false",
    "SELECT TRANSFORM(id) USING 'cat' FROM numbers", "SELECT 1 WHERE EXISTS (SELECT TRANSFORM(id) USING 'cat' FROM numbers)",
])
def test_statements_that_write_are_refused(spark, tmp_path, text):
    spark.range(100).createOrReplaceTempView("numbers")
    out = tmp_path / "out"
    rows, error = shop.bounded_sql(spark, text.format(out=out))
    assert rows is None and error and not out.exists()


def test_reads_of_every_form_are_run(spark):
    spark.range(100).createOrReplaceTempView("numbers")
    for text in ("WITH x AS (SELECT id FROM numbers) SELECT * FROM x WHERE id IN (SELECT max(id) FROM x)", "VALUES (1), (2)",
                 "(SELECT 1) UNION ALL (SELECT 2)", "SHOW TABLES", "DESCRIBE numbers", "EXPLAIN SELECT 1", "FROM numbers SELECT id"):
        rows, error = shop.bounded_sql(spark, text)
        assert error is None and rows.count() >= 1


def test_hours_below_zero_and_single_rows(spark):
    df = spark.createDataFrame([(1, -1.0, -5.0), (2, 90000.0, 3.0)], "id int, time_s double, amount double")
    rows = {r["id"]: r for r in df.transform(tx.amount_log).transform(tx.time_features).transform(tx.amount_z_by_hour).collect()}
    assert rows[1]["hour"] == 23 and rows[1]["day"] == 6 and rows[1]["amount_log"] == 0.0
    assert rows[2]["hour"] == 1 and rows[2]["day"] == 1
    assert rows[2]["amount_z_hour"] is None  # one row has no deviation


def test_equal_amounts_get_deviation_one(spark):
    df = spark.createDataFrame([(1, 0.0, 4.0), (2, 1.0, 4.0)], "id int, time_s double, amount double")
    assert [r["amount_std"] for r in tx.hour_stats(df).collect()] == [1.0]


def test_curves_on_a_known_case(spark):
    rows = [("m", 0.1, 0), ("m", 0.4, 0), ("m", 0.35, 1), ("m", 0.8, 1)]
    counts = score_counts(spark.createDataFrame(rows, "model string, score double, label int"))
    assert average_precision(counts).first()["pr_auc"] == pytest.approx(0.8333333)
    r = evaluate_model(counts).first()
    assert r["roc_auc"] == pytest.approx(0.75) and r["f1"] == pytest.approx(0.8) and r["threshold"] == 0.35


def separable(spark, n=2000):
    base = spark.range(n).select("id", (F.rand(1) * 2 - 1).alias("v1"), (F.rand(2) * 2 - 1).alias("v2"))
    return base.withColumn("class", (F.col("v1") + 0.3 * F.col("v2") + 0.2 * F.randn(3) > 0.9).cast("int"))


def test_split_keeps_the_class_ratio(spark):
    got = ml.stratified_split(separable(spark)).groupBy("class").agg(F.avg((F.col("split") == "test").cast("double")).alias("p")).collect()
    assert all(abs(r["p"] - 0.2) < 0.01 for r in got)


def test_smote_balances_and_interpolates(spark):
    df = separable(spark, 600).cache()
    got = ml.smote(df, ["v1", "v2"])
    sizes = {r["class"]: r["count"] for r in got.groupBy("class").count().collect()}
    assert sizes[0] == sizes[1]
    low, high = df.filter("class = 1").agg(F.min("v1"), F.max("v1")).first()
    new = got.filter("copy >= 0").agg(F.min("v1"), F.max("v1")).first()
    assert low <= new[0] and new[1] <= high


@pytest.mark.parametrize("fit", [ml.fit_logistic, lambda d, f: ml.fit_forest(d, f, trees=20), lambda d, f: ml.fit_boosted(d, f, maxIter=10, maxDepth=3)])
def test_fits_reach_a_floor(spark, fit):
    rows = ml.stratified_split(separable(spark)).cache()
    model = fit(rows.filter("split = 'train'"), ["v1", "v2"])
    scored = ml.predict_scores(model, rows.filter("split = 'test'"), ["id", F.col("class").alias("label")], "m")
    assert scored.filter("score < 0 or score > 1").count() == 0
    assert evaluate_model(score_counts(scored)).first()["pr_auc"] > 0.5  # the positive rate is below 0.1


def test_search_returns_every_draw_and_a_model(spark):
    rows = separable(spark, 800)
    got, model = ml.random_search_cv(rows, ["v1", "v2"], draws=2, folds=2, grid={"maxIter": [3], "maxDepth": [2, 3]})
    assert got.count() == 2 and got.agg(F.min("pr_auc")).first()[0] > 0.5
    assert "probability" in model.transform(rows).columns


def test_search_keeps_only_what_it_fits_on(spark):
    """Each fold of a search keeps a copy of these rows, so columns no fit reads must not come along."""
    rows = separable(spark, 400).withColumn("unused", F.lit("x" * 50))
    stored, weighted = ml._search_rows(rows, ["v1", "v2"], "class")
    assert stored.columns == ["features", "class"] and stored.is_cached and weighted.columns == ["features", "class", "weight"]
    sums = {r["class"]: r["w"] for r in weighted.groupBy("class").agg(F.sum("weight").alias("w")).collect()}
    assert sums[0] == pytest.approx(sums[1])
    assert "Subquery" not in plan(weighted)  # the ratio is a number
    stored.unpersist()


def test_importance_finds_the_feature(spark):
    model = ml.fit_forest(separable(spark), ["v1", "v2"], trees=20)
    got = {r["feature"]: r["importance"] for r in ml.feature_importance(model, ["v1", "v2"]).collect()}
    assert got["v1"] > got["v2"] and sum(got.values()) == pytest.approx(1)


def test_explanation_is_never_empty(spark):
    rows = spark.createDataFrame([("a", 1.0, -3.0)], "asset string, x double, y double")
    got = ml.topk_abs_features(rows, spark.createDataFrame([("a",), ("new",)], "asset string"), ["x", "y"], 1).collect()
    assert {(r["asset"], r["feature"], r["value"]) for r in got} == {("a", "y", -3.0), ("new", "x", 0.0)}


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    from loomwork.plans.shop import star

    items = star(spark, FOLDER)["order_items"].filter(F.col("quantity") > 10).groupBy("product_id").count()
    text = plan(items)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text


@needs_tables
def test_row_scale_windows_have_partitions(spark):
    txn = transactions(spark, FOLDER)
    for df in (tx.velocity_1h(txn), tx.amount_z_by_hour(txn), score_counts(txn.select(F.lit("m").alias("model"), F.col("amount").alias("score"), F.col("class").alias("label")))):
        text = plan(df)
        window_parts = [line for line in text.splitlines() if "Window [" in line and "specifiedwindowframe" in line and "_slice" not in line]
        assert not window_parts, window_parts


@needs_tables
def test_no_join_without_keys(spark):
    import __spark_entry__ as entry

    for name in ("signal_backtest", "hist_by_class", "standard_scale", "latest_cross_section", "kde_by_class", "mean_offdiag_similarity"):
        text = plan(entry.queries()[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_reflection_and_paths_are_refused(spark, tmp_path):
    spark.range(100).createOrReplaceTempView("numbers")
    secret = tmp_path / "secret.txt"
    secret.write_text("not for you")
    for text in ("SELECT reflect('java.lang.System', 'setProperty', 'loomwork.probe', '1')",
                 "SELECT java_method('java.lang.System', 'setProperty', 'loomwork.probe', '1') FROM numbers",
                 "SELECT try_reflect('java.lang.System', 'setProperty', 'loomwork.probe', '1')",
                 "SELECT id FROM numbers WHERE id IN (SELECT reflect('java.lang.System', 'setProperty', 'loomwork.probe', '1'))",
                 f"SELECT * FROM text.`{secret}`", f"WITH x AS (SELECT * FROM parquet.`{tmp_path}`) SELECT * FROM x"):
        rows, error = shop.bounded_sql(spark, text)
        assert rows is None and error, text
    assert spark.sparkContext._jvm.java.lang.System.getProperty("loomwork.probe") is None
    rows, error = shop.bounded_sql(spark, "SELECT n.id FROM numbers n JOIN numbers m ON n.id = m.id + 1 WHERE n.id IN (SELECT max(id) FROM numbers)")
    assert error is None and rows.count() == 1


def test_text_files_are_moved_by_their_tasks(spark, tmp_path):
    from loomwork.sources.files import read_text_docs, write_text_docs

    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (3, None)], "doc_id bigint, text string")
    write_text_docs(docs, f"{tmp_path}/t")
    got = {r["source"].split("doc_id=")[1].split("/")[0]: r["content"] for r in read_text_docs(spark, f"{tmp_path}/t").collect()}
    assert got == {"1": "a b", "2": "c", "3": ""}


def events_table(spark, folder, n=300):
    """An event table of its own, written as ``folder/events.parquet``."""
    kind = F.when(F.col("id") % 7 == 0, "error").otherwise("view")
    spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1704067200 + F.col("id") * 977).alias("ts"), (F.col("id") * 13 % 41).alias("user_id"),
        kind.alias("event_type"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10.0 + F.when(F.col("id") % 7 == 0, 40.0).otherwise(0.0)).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"),
    ).coalesce(1).write.parquet(f"{folder}/events.parquet")


def test_the_search_query_draws_from_the_whole_grid(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry
    from loomwork.operators import trees as tr

    events_table(spark, str(tmp_path))
    asked = []
    fit = tr.held_out_scores
    monkeypatch.setattr(tr, "held_out_scores", lambda blocks, cuts, fold, **s: asked.append((fold, s)) or fit(blocks, cuts, fold, **{**s, "maxIter": 2}))
    monkeypatch.setattr(tr, "boosted", lambda *a, **s: None)
    monkeypatch.setattr(ml, "PipelineModel", lambda stages: stages)
    got = entry.queries()["random_search_cv"](spark, str(tmp_path)).collect()
    assert len(got) == 30 and set(ml.SEARCH_GRID) < set(got[0].asDict())
    assert len(asked) == 90 and {fold for fold, _ in asked} == {0, 1, 2}
    assert all(r[name] in ml.SEARCH_GRID[name] for r in got for name in ("maxIter", "maxDepth", "stepSize", "subsamplingRate", "minInfoGain"))
    assert all(s["maxIter"] >= 100 for _, s in asked)


def test_boosted_trees_are_those_of_spark(spark):
    """Same rows, bins, splits and leaves as Spark's own, with the weights of an unbalanced label."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array

    rows = separable(spark, 900).withColumn("v3", F.floor(F.col("v1") * 3).cast("double")).cache()
    names = ["v1", "v2", "v3"]
    stored, weighted = ml._search_rows(rows, names, "class")
    for settings in ({"maxIter": 12, "maxDepth": 3}, {"maxIter": 6, "maxDepth": 5, "minInstancesPerNode": 5, "minInfoGain": 0.01}):
        theirs = GBTClassifier(labelCol="class", weightCol="weight", stepSize=0.1, seed=1, **settings).fit(weighted).transform(weighted)
        want = [r[0] for r in theirs.select(vector_to_array("probability")[1]).collect()]
        model = ml.fit_boosted(rows, names, seed=1, **settings)
        got = [r["score"] for r in ml.predict_scores(model, rows, ["id"], "m").collect()]
        assert got == pytest.approx(want, abs=1e-9)
    stored.unpersist()


def test_boosted_trees_above_a_task_are_left_to_spark(spark, monkeypatch):
    from loomwork.operators import trees as tr

    rows = separable(spark, 300).cache()
    monkeypatch.setattr(tr, "TASK_ROWS", 100)
    assert not isinstance(ml.fit_boosted(rows, ["v1", "v2"], maxIter=2).stages[-1], tr.BoostedModel)
    got, _ = ml.random_search_cv(rows, ["v1", "v2"], draws=2, folds=2, grid={"maxIter": [2], "maxDepth": [2, 3]})
    assert got.count() == 2


def test_text_files_are_written_whole_without_a_writer_of_their_own(spark, tmp_path):
    """Spark's writer leaves a checksum beside every file and starts a process to set its mode."""
    rows = [("1", "a\nb"), ("1", "a\nb"), ("2", None), (None, "no key"), ("", "empty key"), ("x/y=%", "é "), ("x y", "z")]
    docs = spark.createDataFrame(rows, "name string, text string").repartition(3)
    files.write_text_docs(docs, f"file:{tmp_path}/here", "name")
    docs.repartition("name").write.partitionBy("name").text(f"{tmp_path}/spark")

    def texts(folder):
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(f"{tmp_path}/{folder}")
        return {r["path"].split("/")[-2]: sorted(bytes(r["content"]).splitlines()) for r in listed.collect()}

    assert texts("here") == texts("spark") and len(texts("here")) == 5
    assert {name for _, _, names in os.walk(tmp_path / "here") for name in names} == {"part-00000.txt"}
    with pytest.raises(FileExistsError):
        files.write_text_docs(docs, f"{tmp_path}/here", "name")


def test_only_mounted_folders_are_written_directly(spark):
    assert files.mounted(spark, "/a/b") == files.mounted(spark, "file:/a/b") == files.mounted(spark, "file:///a/b") == "/a/b"
    assert files.mounted(spark, "hdfs://host/a/b") is None and files.mounted(spark, "s3a://bucket/a") is None


def test_many_small_files_are_a_few_tasks(spark, tmp_path):
    from loomwork.session import small_files

    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(600):
        (folder / f"{i}.txt").write_text(f"text {i}")
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        plain = files.read_text_docs(spark, str(folder)).rdd.getNumPartitions()
        with small_files(spark):
            packed = files.read_text_docs(spark, str(folder))
            assert packed.rdd.getNumPartitions() <= 9 < plain
            assert packed.select("content").distinct().count() == 600
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert spark.conf.get(name) == before

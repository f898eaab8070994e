"""Nearest neighbours by both paths against brute force, and vector summaries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.functions.vectors import l2_normalise
from loomwork.operators import vectors as vx


def frame(spark, matrix, name):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], f"{name} bigint, v array<double>")


def brute(cands, queries, k, metric):
    if metric == "ip":
        scores = np.round(queries @ cands.T, 12)
    else:
        scores = -((queries[:, None, :] - cands[None]) ** 2).sum(-1)
    return {(q, r + 1): c for q in range(len(queries)) for r, c in enumerate(np.lexsort((np.arange(len(cands)), -scores[q]))[:k])}


@pytest.mark.parametrize("metric", ["ip", "l2"])
@pytest.mark.parametrize("path", ["few", "many"])
def test_nearest(spark, monkeypatch, metric, path):
    rng = np.random.default_rng(4)
    cands = rng.integers(-3, 4, (900, 4)).astype(float)  # few distinct values: many ties
    queries = rng.integers(-3, 4, (37, 4)).astype(float)
    if path == "many":
        monkeypatch.setattr(vx, "QUERY_ROWS", 10)
        monkeypatch.setattr(vx, "GRID_ROWS", 100)
    got = vx.nearest(frame(spark, cands, "cand_id").repartition(5), frame(spark, queries, "query_id"), 6, metric).collect()
    assert {(r["query_id"], r["rank"]): r["cand_id"] for r in got} == brute(cands, queries, 6, metric)


def test_fewer_candidates_than_k(spark):
    got = vx.topk_similar(frame(spark, np.eye(3), "cand_id"), frame(spark, np.eye(3)[:1], "query_id"), 5)
    assert got.count() == 3
    assert vx.topk_similar(frame(spark, np.eye(3), "cand_id").filter("cand_id < 0"), frame(spark, np.eye(3)[:1], "query_id"), 5).count() == 0


def test_zero_vector_stays(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r["u"] for r in df.select(l2_normalise("v").alias("u")).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_mean_similarity_without_pairs(spark):
    m = np.random.default_rng(1).normal(size=(60, 8))
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = u @ u.T
    got = vx.mean_offdiag_similarity(frame(spark, m, "id")).first()["mean_similarity"]
    assert got == pytest.approx((s.sum() - np.trace(s)) / (60 * 60 - 60))


def test_principal_components(spark):
    m = np.random.default_rng(3).normal(size=(80, 5)) * [5, 3, 1, 0.5, 0.1]
    got = vx.pca_2d(frame(spark, m, "id"), ["id"]).toPandas().sort_values("id")
    centred = m - m.mean(0)
    _, sv, vt = np.linalg.svd(centred, full_matrices=False)
    for i, name in enumerate(["pc1", "pc2"]):
        assert np.allclose(np.abs(got[name]), np.abs(centred @ vt[i]))
    assert got["var1"].iloc[0] == pytest.approx(sv[0] ** 2 / (sv**2).sum())


def test_hashed_texts_are_unit_vectors(spark):
    df = spark.createDataFrame([(1, "red cat"), (2, "red dog"), (3, "red cat")], "id int, content string")
    rows = {r["id"]: np.array(r["embedding"]) for r in vx.hash_embed(df, "content", 64).collect()}
    assert all(np.linalg.norm(v) == pytest.approx(1) for v in rows.values())
    assert rows[1] @ rows[3] == pytest.approx(1) and rows[1] @ rows[2] < 0.5


def test_unit_vectors_and_blank_texts(spark):
    from loomwork.functions.vectors import l2_normalise

    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [])], "id int, v array<double>")
    got = {r["id"]: r["u"] for r in df.select("id", l2_normalise("v").alias("u")).collect()}
    assert got == {1: [0.6, 0.8], 2: [0.0, 0.0], 3: None, 4: []}
    texts = spark.createDataFrame([(1, None), (2, ""), (3, "a b")], "id int, content string")
    rows = {r["id"]: r["embedding"] for r in vx.hash_embed(texts, "content", 16).collect()}
    assert rows[1] == rows[2] == [0.0] * 16 and np.linalg.norm(rows[3]) == pytest.approx(1)


def test_retrieval_takes_any_encoder_and_keeps_to_k(spark):
    store = spark.createDataFrame([(1, "red", "a.txt"), (2, "green green", "b.txt"), (3, "red green", "c.txt")], "cand_id long, content string, filename string")
    asked = spark.createDataFrame([(7, "red"), (8, "green")], "query_id long, question string")

    def encoder(rows, column):
        count = [F.size(F.array_remove(F.transform(F.split(column, " "), lambda w: w == colour), False)) for colour in ("red", "green")]
        return rows.withColumn("embedding", F.array(*[c.cast("double") for c in count]))

    found = vx.retrieve(store, asked, encoder, 2).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["filename"]) for r in found] == [(7, 1, "a.txt"), (7, 2, "c.txt"), (8, 1, "b.txt"), (8, 2, "c.txt")]
    assert found[0]["score"] == pytest.approx(1) and found[1]["score"] == pytest.approx(0.5 ** 0.5)
    built_in = vx.retrieve(store, asked, vx.hash_encoder(store, "content", 64), 1).collect()
    assert {(r["query_id"], r["cand_id"]) for r in built_in} == {(7, 1), (8, 2)}


def test_k_sweep(spark):
    found = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.5), (2, 1, 0.8), (2, 2, 0.0)], "query_id int, rank int, score double")
    got = {r["k"]: (r["mean_cr"], r["std_cr"]) for r in vx.k_sweep(found, [1, 2]).collect()}
    assert got[1] == pytest.approx((0.9, 0.1)) and got[2] == pytest.approx((0.575, 0.175))


@pytest.mark.parametrize("block", [2, 512])
def test_group_similarity(spark, block):
    m = np.random.default_rng(9).normal(size=(50, 6))
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    group = np.arange(50) % 7
    df = frame(spark, m, "id").withColumn("label", (F.col("id") % 7).cast("int"))
    got = {(r["group_a"], r["group_b"]): r["similarity"] for r in vx.similarity_matrix(df, "label", block).collect()}
    assert len(got) == 28
    for (a, b), value in got.items():
        assert value == pytest.approx((u[group == a] @ u[group == b].T).mean())


def test_cell_neighbours_are_exact(spark):
    from loomwork.operators.vectors import cell_neighbours

    rng = np.random.default_rng(5)
    pts = np.round(rng.normal(0, 1, (700, 3)), 1)  # rounding makes many ties
    pts[100:160] = pts[99]  # a group of copies
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(pts)] + [(900, [float("nan"), 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = sorted((r["query_id"], r["rank"], r["cand_id"]) for r in cell_neighbours(df, 5, leaf_rows=16, sample_rows=200).collect())
    want = []
    for i, p in enumerate(pts):
        d = ((pts - p) ** 2).sum(1)
        order = sorted((d[j], j) for j in range(len(pts)) if j != i)[:5]
        want += [(i, r + 1, j) for r, (_, j) in enumerate(order)]
    assert got == sorted(want)
    assert cell_neighbours(df.limit(0), 5).count() == 0


def test_the_plan_of_a_deep_tree_stays_small(spark):
    rng = np.random.default_rng(7)
    points = rng.random((400, 3))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id bigint, v array<double>").repartition(2)
    found = vx.cell_neighbours(df, 2, leaf_rows=4, sample_rows=400)  # seven levels
    assert len(found._jdf.queryExecution().analyzed().toString()) < 50_000
    far = ((points[:, None] - points[None]) ** 2).sum(2)
    np.fill_diagonal(far, np.inf)
    want = {(q, r + 1): c for q in range(400) for r, c in enumerate(np.argsort(far[q], kind="stable")[:2])}
    assert {(r["query_id"], r["rank"]): r["cand_id"] for r in found.collect()} == want


def test_many_queries_do_not_multiply_the_candidates(spark, monkeypatch):
    rng = np.random.default_rng(12)
    cands = np.repeat(rng.random((150, 6)), 3, axis=0)  # every vector three times: ties
    queries = np.vstack([rng.random((40, 6)), np.zeros((2, 6))])
    monkeypatch.setattr(vx, "QUERY_ROWS", 10)
    monkeypatch.setattr(vx, "GRID_ROWS", 100)
    found = vx.nearest(frame(spark, cands, "cand_id").repartition(3), frame(spark, queries, "query_id"), 4)
    assert "CoGroup" not in found._jdf.queryExecution().analyzed().toString()
    assert {(r["query_id"], r["rank"]): r["cand_id"] for r in found.collect()} == brute(cands, queries, 4, "ip")


def test_twenty_thousand_queries_are_one_scan(spark, monkeypatch):
    """Every part of the queries has all candidates encoded again, so a part holds what a task can."""
    scans, scan = [], vx._against
    monkeypatch.setattr(vx, "_against", lambda *a: scans.append(1) or scan(*a))
    cands = spark.range(40).select(F.col("id").alias("cand_id"), F.array((F.col("id") - 20).cast("double"), F.lit(1.0)).alias("v"))
    asks = spark.range(20000).select(F.col("id").alias("query_id"), F.array(F.when(F.col("id") % 2 == 0, 1.0).otherwise(-1.0), F.lit(0.0)).alias("v"))
    got = vx.nearest(cands, asks, 2).groupBy((F.col("query_id") % 2).alias("odd"), "rank", "cand_id").count().collect()
    assert {(r["odd"], r["rank"], r["cand_id"], r["count"]) for r in got} == {(0, 1, 39, 10000), (0, 2, 38, 10000), (1, 1, 0, 10000), (1, 2, 1, 10000)}
    assert len(scans) == 1


def test_lengths_beyond_single_precision_are_screened_in_double(spark):
    cands = spark.createDataFrame([(1, [3e30, 1.0]), (2, [4e30, 1.0]), (3, [-4e30, 2.0])], "cand_id bigint, v array<double>")
    asks = spark.createDataFrame([(7, [2e20, 0.0])], "query_id bigint, v array<double>")
    assert [r["cand_id"] for r in vx.nearest(cands, asks, 3).orderBy("rank").collect()] == [2, 1, 3]

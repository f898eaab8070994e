"""Nearest neighbours and summaries over the embeddings.

The questions asked are the mean vectors of the labels, so their number grows with the labels.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.operators import texts as tt
from loomwork.operators import vectors as vx
from loomwork.plans.registry import register, select_sql
from loomwork.sources.derived import DOC_SQL, documents, vectors

VEC = """vec AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
el AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM vec),
unit AS (SELECT vec_id, label, CASE WHEN n > 0 THEN list_transform(v, lambda x: x / n) ELSE v END AS v
         FROM (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM vec)),
cent AS (SELECT label, list(m ORDER BY pos) AS v FROM (SELECT label, pos, avg(x) AS m FROM el GROUP BY 1, 2) GROUP BY 1),
ask AS (SELECT label AS query_id, list_transform(v, lambda x: x / n) AS v FROM (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM cent)),
sim AS (SELECT query_id, vec_id AS cand_id, round(list_inner_product(a.v, u.v), 12) AS score FROM ask a CROSS JOIN unit u),
found AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, cand_id) AS rank FROM sim)"""


def base(spark, folder):
    return vectors(spark, folder).select(F.col("vec_id").alias("cand_id"), F.col("embedding").alias("v"), "label")


def found(spark, folder, k=5):
    rows = base(spark, folder)
    return vx.topk_similar(rows, vx.centroids(rows, "label"), k)


def found_documents(spark, folder, k=5):
    """Ranked results with the document of the same number."""
    docs = documents(spark, folder).select(F.col("doc_id").alias("cand_id"), "filename", "content")
    return found(spark, folder, k).join(docs, "cand_id", "left")


@register("topk_similar", select_sql(VEC, "found", "", "score", "query_id cand_id rank", tail="WHERE rank <= 5"))
def _(spark, folder):
    return found(spark, folder, 5)


@register("topk_queries_demo", select_sql(VEC, "found", "", "score", "query_id cand_id rank", tail="WHERE rank <= 3"))
def _(spark, folder):
    return found(spark, folder, 3)


@register("l2_normalise", """SELECT vec_id, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) + 0.0 AS length, round(v[1], 6) + 0.0 AS first, round(v[len(v)], 6) + 0.0 AS last
FROM (SELECT vec_id, CASE WHEN n > 0 THEN list_transform(v, lambda x: x / n) ELSE v END AS v
      FROM (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)))""")
def _(spark, folder):
    from loomwork.functions.vectors import l2_normalise, norm

    unit = vectors(spark, folder).select("vec_id", l2_normalise("embedding").alias("v"))
    return unit.select("vec_id", norm("v").alias("length"), F.element_at("v", 1).alias("first"), F.element_at("v", -1).alias("last"))


@register("vector_table_io", "SELECT max(len(embedding)) AS dim, count(*) AS total FROM embeddings")
def _(spark, folder):
    """Write the vectors, read them back, report dimension and number."""
    from loomwork.session import fresh_path
    from loomwork.sources.files import read_vectors, vector_profile, write_vectors

    path = fresh_path(spark, "vectors")
    write_vectors(vectors(spark, folder), path)
    return vector_profile(read_vectors(spark, path))


@register("source_preview", f"""WITH {VEC}, {DOC_SQL}
SELECT query_id::BIGINT AS query_id, rank, coalesce(filename, 'unknown') AS filename, round(score, 3) + 0.0 AS score, replace(substr(content, 1, 200), chr(10), ' ') || '...' AS preview
FROM found LEFT JOIN docs ON doc_id = cand_id WHERE rank <= 3""")
def _(spark, folder):
    return tt.source_preview(found_documents(spark, folder))


@register("context_relevance_dense", select_sql(f"{VEC}, o AS (SELECT query_id, avg(score) AS context_relevance FROM found WHERE rank <= 5 GROUP BY 1)", "o", "", "context_relevance", "query_id"))
def _(spark, folder):
    return vx.context_relevance_dense(found(spark, folder, 5))


@register("similarity_matrix", """WITH vec AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
unit AS (SELECT vec_id, label, CASE WHEN n > 0 THEN list_transform(v, lambda x: x / n) ELSE v END AS v
         FROM (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM vec))
SELECT a.label::BIGINT AS group_a, b.label::BIGINT AS group_b, round(avg(list_inner_product(a.v, b.v)), 6) + 0.0 AS similarity
FROM unit a JOIN unit b ON a.label <= b.label GROUP BY 1, 2""")
def _(spark, folder):
    """Mean cosine between labels."""
    return vx.similarity_matrix(base(spark, folder), "label")


@register("mean_offdiag_similarity", """WITH vec AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
unit AS (SELECT vec_id, CASE WHEN n > 0 THEN list_transform(v, lambda x: x / n) ELSE v END AS v
         FROM (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM vec))
SELECT round(avg(list_inner_product(a.v, b.v)), 6) + 0.0 AS mean_similarity, (SELECT count(*) FROM unit) AS n FROM unit a JOIN unit b ON a.vec_id <> b.vec_id""")
def _(spark, folder):
    return vx.mean_offdiag_similarity(base(spark, folder))


@register("pca_2d")
def _(spark, folder):
    return vx.pca_2d(base(spark, folder).withColumnRenamed("cand_id", "vec_id"), ["vec_id", "label"])

"""The registered queries of this subpackage: thin digests of the operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import (
    centroids, contamination, conversations, fingerprints, jaccard, language, lines, mixing, privacy, quality, suffixes, tokens, toxicity,
)
from loomwork.llm.common import documents, held_out
from loomwork.session import fresh_path

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        _QUERIES[name] = fn
        if sql:
            _ORACLES[name] = sql
        return fn

    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


@register("op1_language_id")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = language.fit(docs.where(~held_out(F.col("doc_id"))))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@register("op3_source_mixing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder))
    return mixed.select("doc_id", "size", "source_size", "target", mixing.taken_words(F.col("pieces")).alias("taken"))


OP5_SQL = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each_line AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM split),
keyed AS (SELECT doc_id, place, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM each_line),
frequent AS (SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT k.*, coalesce(f.owner <> k.doc_id, false) AS gone FROM keyed k LEFT JOIN frequent f USING (key))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@register("op5_line_dedup", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.drop_repeated_lines(documents(spark, folder).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH lowered AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
  UNION ALL
  SELECT 'b', CAST(item_id AS VARCHAR), translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
worded AS (SELECT kind, id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
items AS (SELECT id, w, least(len(w), 10) AS n FROM worded WHERE kind = 'b' AND len(w) > 0),
windows AS (SELECT DISTINCT id AS item, n, array_to_string(w[s + 1 : s + n], ' ') AS phrase
            FROM (SELECT id, w, n, unnest(range(len(w) - n + 1)) AS s FROM items)),
places AS (SELECT id, s, n, array_to_string(w[s + 1 : s + n], ' ') AS phrase
           FROM (SELECT id, w, n, unnest(range(len(w) - n + 1)) AS s FROM worded, (SELECT DISTINCT n FROM windows) WHERE kind = 'd' AND len(w) >= n)),
hits AS (SELECT p.id, p.s, p.n, x.item FROM places p JOIN windows x ON p.n = x.n AND p.phrase = x.phrase),
hit_words AS (SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, unnest(range(s, s + n)) AS place FROM hits) GROUP BY id),
hit_items AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM hits) GROUP BY id)
SELECT CAST(w.id AS BIGINT) AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM worded w LEFT JOIN hit_words USING (id) LEFT JOIN hit_items USING (id) WHERE w.kind = 'd'
"""


@register("op8_decontamination", OP8_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.contamination(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@register("op9_quality_rules")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    table = quality.ratio_table(docs, quality.trusted_ids(spark.read.parquet(f"{folder}/labels.parquet")))
    return quality.judge(docs, table)


OP6_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE [array_to_string(w[i + 1 : i + 3], ' ') FOR i IN range(len(w) - 2)] END) AS shingle FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (SELECT x, y FROM common JOIN sizes sx ON x = sx.doc_id JOIN sizes sy ON y = sy.doc_id WHERE 100 * c >= 90 * (sx.n + sy.n - c)),
sides AS (SELECT x, y FROM linked UNION SELECT y, x FROM linked),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, s.y FROM reach r JOIN sides s ON r.other = s.x)
SELECT r.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, CAST(min(other) AS BIGINT) AS component_id
FROM reach r LEFT JOIN sizes USING (doc_id) GROUP BY r.doc_id
"""


@register("op6_ngram_jaccard", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_components(documents(spark, folder))


@register("op4_toxicity")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@register("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.document_tokens(documents(spark, folder), fresh_path(spark, "tokens"))


@register("op7_pseudonyms")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = privacy.pseudonymise(documents(spark, folder).select("doc_id", "text"), b"example key: give your own")
    return found.select("doc_id", "text", *[F.col(f"n_{kind}").cast("long").alias(f"n_{kind}") for kind in privacy.KINDS])


OP10_SQL = r"""
WITH coded AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(CAST(length(h) // 2 - 49 AS BIGINT))) AS s FROM coded WHERE length(h) >= 100),
strings AS (SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS string FROM starts),
firsts AS (SELECT string, min(doc_id) AS first FROM strings GROUP BY string HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS place FROM strings JOIN firsts USING (string) WHERE doc_id > first),
edges AS (SELECT doc_id, place, place - coalesce(lag(place) OVER (PARTITION BY doc_id ORDER BY place), -9) AS gap FROM gone),
removed AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE gap <> 1) AS n_spans FROM edges GROUP BY doc_id),
bytes AS (SELECT doc_id, h, unnest(range(CAST(length(h) // 2 AS BIGINT))) AS place FROM coded WHERE doc_id IN (SELECT doc_id FROM removed)),
kept AS (SELECT b.doc_id, string_agg(substr(h, 2 * b.place + 1, 2), '' ORDER BY b.place) AS k
         FROM bytes b LEFT JOIN gone g ON b.doc_id = g.doc_id AND b.place = g.place WHERE g.place IS NULL GROUP BY b.doc_id)
SELECT c.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n_removed IS NULL THEN h ELSE coalesce(k, '') END)) AS kept_sha256
FROM coded c LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@register("op10_suffix_dedup", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffixes.remove_repeats(documents(spark, folder))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op11_conversation_repair")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_damaged(spark.read.parquet(f"{folder}/conversations.parquet"))


@register("op12_centroid_clustering")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))


@register("op13_document_fingerprints")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(documents(spark, folder)).drop("edited")

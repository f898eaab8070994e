"""Working tables derived from the base tables, with the same derivation in SQL.

Each function reads whole tables; the ``*_SQL`` strings are the matching common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.functions.clock import seconds


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def prices(spark: SparkSession, folder: str, asset: str = "p_type") -> DataFrame:
    """Daily closes ``(date, asset, close)``: value over quantity shipped that day, in steps of 0.0001.

    Sums run over whole cents and units, so every engine gets the same close. The join carries four narrow
    columns; the sums are combined map-side, so a much-traded asset reaches the shuffle as one row per task and day.
    """
    items = table(spark, folder, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        "l_partkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.col("l_quantity").cast("bigint").alias("units"),
    )
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col(asset).alias("asset"))
    per_unit = F.sum("cents").cast("double") / F.sum("units").cast("double")
    return (
        items.join(parts, "l_partkey")
        .groupBy("date", "asset")
        .agg((F.floor(per_unit * 100.0 + 0.5).cast("double") / 10000.0).alias("close"))
    )


def supplier_prices(spark: SparkSession, folder: str) -> DataFrame:
    """The same closes per supplier: a panel of many assets."""
    items = table(spark, folder, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_suppkey").alias("asset"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.col("l_quantity").cast("bigint").alias("units"),
    )
    per_unit = F.sum("cents").cast("double") / F.sum("units").cast("double")
    return items.groupBy("date", "asset").agg((F.floor(per_unit * 100.0 + 0.5).cast("double") / 10000.0).alias("close"))


def prices_sql(asset: str = "p_type", name: str = "px") -> str:
    return f"""{name} AS (
  SELECT CAST(l_shipdate AS DATE) AS date, {asset} AS asset,
         floor(CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
               / CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) * 100.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS close
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


def as_transactions(events: DataFrame, start: Column) -> DataFrame:
    """Events, at rest or as a stream, as ``(id, time_s, amount, v1..v4, user_id, class)``.

    ``start`` is the epoch second the times count from.
    """
    ident, user = F.col("event_id"), F.col("user_id")
    return events.select(
        ident.alias("id"),
        (seconds("ts") - start).alias("time_s"),
        F.col("value").alias("amount"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("v1"),
        ((user * 37 % 101) / 101).alias("v2"),
        ((ident * 7919 % 997) / 997).alias("v3"),
        (((ident + user) * 31 % 103) / 103).alias("v4"),
        "user_id",
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("class"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as transactions; seconds count from the first event."""
    events = table(spark, folder, "events")
    return as_transactions(events, events.agg(F.min(seconds("ts"))).scalar())


TXN_SQL = """ev AS (
  SELECT event_id AS id, epoch_us(ts) / 1000000.0::DOUBLE AS moment, value AS amount,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, user_id,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS class FROM events),
txn AS (
  SELECT id, moment - (SELECT min(moment) FROM ev) AS time_s, amount, k / 100::DOUBLE AS v1,
         (user_id * 37 % 101) / 101::DOUBLE AS v2, (id * 7919 % 997) / 997::DOUBLE AS v3,
         ((id + user_id) * 31 % 103) / 103::DOUBLE AS v4, user_id, class FROM ev)"""


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """``(model, id, score, label)``: three score columns of the same events, with many ties."""
    txn = transactions(spark, folder)
    lists = F.array(
        F.struct(F.lit("amount").alias("model"), (F.floor(F.col("amount") / 5) / 100).alias("score")),
        F.struct(F.lit("blend").alias("model"),
                 (F.floor((F.col("v1") + F.col("v2") + 2 * F.col("class") * F.col("v3")) * 250) / 1000).alias("score")),
        F.struct(F.lit("noise").alias("model"), (F.floor(F.col("v3") * 1000) / 1000).alias("score")),
    )
    return txn.select("id", F.col("class").alias("label"), F.inline(lists)).select("model", "id", "score", "label")


SCORE_SQL = TXN_SQL + """,
sc AS (
  SELECT 'amount' AS model, id, floor(amount / 5) / 100 AS score, class AS label FROM txn
  UNION ALL SELECT 'blend', id, floor((v1 + v2 + 2 * class * v3) * 250) / 1000, class FROM txn
  UNION ALL SELECT 'noise', id, floor(v3 * 1000) / 1000, class FROM txn)"""


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, filename, file_type, content)``; even documents get blank-line paragraphs."""
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id",
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"),
        F.lit("txt").alias("file_type"),
        F.when(F.col("doc_id") % 2 == 0, F.replace(text, F.lit("\n"), F.lit("\n\n"))).otherwise(text).alias("content"),
    )


DOC_SQL = r"""docs AS (
  SELECT doc_id, 'doc_' || doc_id || '.txt' AS filename, 'txt' AS file_type,
         CASE WHEN doc_id % 2 = 0 THEN replace(text, chr(10), chr(10) || chr(10)) ELSE text END AS content
  FROM documents)"""


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """``(vec_id, embedding ARRAY<DOUBLE>, label)``."""
    return table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").cast(T.ArrayType(T.DoubleType())).alias("embedding"), "label"
    )


def question_answers(spark: SparkSession, folder: str) -> DataFrame:
    """``(conv_id, turn, question, answer)``: a user turn and the assistant turn right after it."""
    talk = table(spark, folder, "conversations")
    asked = talk.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    said = talk.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(said, ["conv_id", "turn"])


QA_SQL = """qa AS (
  SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant')"""

"""Stream operators run over the event file, checked against the same question asked of the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.functions.clock import seconds
from loomwork.operators import transactions as tx
from loomwork.plans.registry import register, select_sql
from loomwork.plans.transactions import HOUR
from loomwork.sources.derived import TXN_SQL, as_transactions, table, transactions
from loomwork.streaming import alerts
from loomwork.streaming.run import append_now, file_stream, upsert_now
from loomwork.streaming.scoring import ingest_batches, stream_ingest_docs, stream_score, stream_velocity

AS_OF = 1707004800.0  # 2024-02-04 00:00:00


def event_stream(spark, folder):
    return file_stream(spark, folder, "events.parquet", table(spark, folder, "events").schema)


@register("stream_event_counters", """
SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def _(spark, folder):
    return upsert_now(alerts.event_counters(event_stream(spark, folder)), ["window_start", "event_type"])


@register("stream_latency_p95", """
WITH w AS (SELECT CAST(floor(epoch(ts) / 300) * 300 AS BIGINT) AS window_start, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY 1)
SELECT w.window_start, round(w.p95, 6) + 0.0 AS p95, w.p95 > 60 AS over, w.p95 > 60 AND coalesce(b.p95 > 60, false) AS alert
FROM w LEFT JOIN w b ON b.window_start = w.window_start - 300""")
def _(spark, folder):
    """Windows and threshold on the stream, then the hold over two windows in a row; the sketch is exact for so few values a window."""
    return alerts.held_alerts(upsert_now(alerts.latency_windows(event_stream(spark, folder)), ["window_start"]), 60.0)


@register("latency_p95_exact", """
WITH w AS (SELECT CAST(floor(epoch(ts) / 300) * 300 AS BIGINT) AS window_start, quantile_cont(value, 0.95) AS p95 FROM events GROUP BY 1)
SELECT w.window_start, round(w.p95, 6) + 0.0 AS p95, w.p95 > 60 AS over, w.p95 > 60 AND coalesce(b.p95 > 60, false) AS alert
FROM w LEFT JOIN w b ON b.window_start = w.window_start - 300""")
def _(spark, folder):
    """The latency alert over the event table with exact, interpolated quantiles (a busy window is split by rank)."""
    return alerts.held_alerts(alerts.latency_windows_exact(table(spark, folder, "events")), 60.0)


@register("stream_freshness", f"""
SELECT round(({AS_OF}::DOUBLE - max(epoch_us(ts)) / 1000000.0::DOUBLE) / 3600, 6) + 0.0 AS age_hours,
       ({AS_OF}::DOUBLE - max(epoch_us(ts)) / 1000000.0::DOUBLE) / 3600 > 36 AS stale FROM events""")
def _(spark, folder):
    newest = alerts.newest_event(event_stream(spark, folder)).withColumn("one", F.lit(1))
    return alerts.freshness(upsert_now(newest, ["one"]), AS_OF)


@register("stream_score", f"""WITH {TXN_SQL},
stats AS (SELECT {HOUR} AS hour, avg(amount) AS m, CASE WHEN stddev_samp(amount) = 0 THEN 1 ELSE stddev_samp(amount) END AS s FROM txn GROUP BY 1),
f AS (SELECT id, coalesce((amount - m) / s, 0) AS z, v1, v3 FROM txn LEFT JOIN stats ON hour = {HOUR}),
p AS (SELECT id, 1 / (1 + exp(-(z + 3 * v1 * v3 - 0.5))) AS score FROM f)
SELECT id, round(score, 4) + 0.0 AS fraud_probability, CASE WHEN score >= 0.782 THEN 'fraud' ELSE 'legitimate' END AS prediction FROM p""")
def _(spark, folder):
    """The event stream scored with a fixed logistic expression on stored hour statistics."""
    start = table(spark, folder, "events").agg(F.min(seconds("ts"))).first()[0]
    stats = tx.hour_stats(transactions(spark, folder))
    stream = as_transactions(event_stream(spark, folder), F.lit(start))

    def scorer(rows):
        return rows.withColumn("score", 1 / (1 + F.exp(-(F.col("amount_z_hour") + 3 * F.col("v1_v3") - 0.5))))

    return append_now(stream_score(stream, stats, scorer, 0.782).select("id", "fraud_probability", "prediction"))


@register("stream_velocity", select_sql("""cut AS (SELECT (epoch_ms(max(ts)) - 3600000) * 1000 AS passed FROM events),
o AS (SELECT a.event_id AS id, a.user_id, count(b.event_id) AS velocity_count_1h, coalesce(sum(b.value), 0) AS velocity_amount_1h
  FROM events a LEFT JOIN events b ON b.user_id = a.user_id AND b.ts >= a.ts - INTERVAL 1 HOUR AND (b.ts < a.ts OR (b.ts = a.ts AND b.event_id < a.event_id))
  WHERE epoch_us(a.ts) < (SELECT passed FROM cut) GROUP BY 1, 2)""", "o", "", "velocity_amount_1h", "id user_id velocity_count_1h"))
def _(spark, folder):
    """Rows the watermark has passed; those of the last hour still wait."""
    events = event_stream(spark, folder).select("event_id", "ts", "user_id", "value")
    return append_now(stream_velocity(events))


INGEST_FILES = 2000  # files a micro-batch takes at most


def _ingest_sql():
    from loomwork.plans.texts import chunks_sql, strip_sql
    from loomwork.sources.derived import DOC_SQL

    return select_sql(f"""{DOC_SQL},
sdocs AS (SELECT doc_id, filename, file_type, {strip_sql('content')} AS content FROM docs),
{chunks_sql(src='sdocs')}""", "chunks", "doc_id file_type content", "", "chunk_count chunk_index")


@register("stream_ingest_docs", _ingest_sql())
def _(spark, folder):
    """The documents as one text file each in the shared folder, taken as a file stream, chunked, encoded and stored
    batch by batch (each batch once, also after a restart)."""
    from loomwork.operators.vectors import hash_encoder
    from loomwork.session import fresh_path, small_files
    from loomwork.sources.derived import documents
    from loomwork.sources.files import write_text_docs

    files = fresh_path(spark, "ingest-in")
    write_text_docs(documents(spark, folder).select("doc_id", "content"), files)
    encoder = hash_encoder(documents(spark, folder), "content")
    with small_files(spark):  # a stream keeps the settings it starts with
        stored = ingest_batches(stream_ingest_docs(spark, files, files_per_batch=INGEST_FILES), fresh_path(spark, "ingest"), fresh_path(spark, "ingest-progress"), encoder)
    ident = F.regexp_extract("source", r"doc_id=(\d+)", 1).cast("bigint").alias("doc_id")
    return stored.select(ident, "file_type", "content", F.col("chunk_count").cast("bigint").alias("chunk_count"), F.col("chunk_index").cast("bigint").alias("chunk_index"))

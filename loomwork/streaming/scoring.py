"""Scoring and trailing sums of a transaction stream, and ingesting documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomwork.operators.texts import chunk_documents
from loomwork.operators.transactions import HOUR_S, score_decision, serving_features
from loomwork.sources.files import as_documents

_OUT = "id bigint, user_id bigint, velocity_count_1h bigint, velocity_amount_1h double"
_STATE = "user array<bigint>, at array<double>, id array<bigint>, amount array<double>, waiting array<boolean>"
SPAN_HOURS = 2    # a state group covers two hours (and the hour before as history)
USER_GROUPS = 32  # … of the users whose hash is equal modulo this


def stream_score(stream: DataFrame, stats: DataFrame, scorer: Callable[[DataFrame], DataFrame], threshold: float) -> DataFrame:
    """Features with stored hour statistics (24 rows, broadcast), a score and the verdict; no state.

    ``scorer`` adds ``score``: a fitted model's transform, or an expression.
    """
    return score_decision(scorer(serving_features(stream, stats)), threshold)


def _step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Some users' span of time. Rows wait until the watermark passes them, then see all earlier rows of their user's last hour."""
    mark = state.getCurrentWatermarkMs() / 1000.0
    user, at, ident, amount, waiting = (list(x) for x in state.get) if state.exists else ([], [], [], [], [])
    for frame in frames:
        frame = frame[frame["at"] >= mark]  # later rows would change counts already given out
        user += frame["user_id"].astype("int64").tolist()
        at += frame["at"].tolist()
        ident += frame["id"].tolist()
        amount += frame["amount"].tolist()
        waiting += frame["native"].tolist()
    if not at:
        if state.exists:
            state.remove()
        return
    order = np.lexsort((ident, at, user))
    u, t, i, a = np.array(user)[order], np.array(at)[order], np.array(ident)[order], np.array(amount)[order]
    w = np.array(waiting, dtype=bool)[order]
    ready = np.flatnonzero(w & (t < mark))
    if len(ready):
        count, spent = np.zeros(len(u), dtype=np.int64), np.zeros(len(u))
        starts = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
        for low, high in zip(starts, np.append(starts[1:], len(u))):  # one user's rows
            place = np.arange(high - low)
            first = np.searchsorted(t[low:high], t[low:high] - HOUR_S, side="left")
            total = np.concatenate([[0.0], np.cumsum(a[low:high])])
            count[low:high], spent[low:high] = place - first, total[place] - total[first]
        w[ready] = False
        yield pd.DataFrame({"id": i[ready], "user_id": u[ready], "velocity_count_1h": count[ready], "velocity_amount_1h": spent[ready]})
    closes = float(key[2])
    if mark >= closes:  # no row of this span can arrive any more
        if state.exists:
            state.remove()
        return
    keep = w | (t >= mark - HOUR_S)  # older rows are no longer in anybody's last hour
    u, t, i, a, w = u[keep], t[keep], i[keep], a[keep], w[keep]
    state.update((u.tolist(), t.tolist(), i.tolist(), a.tolist(), w.tolist()))
    due = t[w].min() if w.any() else closes
    state.setTimeoutTimestamp(max(int(due * 1000), state.getCurrentWatermarkMs() + 1))


def stream_velocity(events: DataFrame, delay: str = "1 hour", span_hours: int = SPAN_HOURS) -> DataFrame:
    """Count and spend of each user's previous hour over a stream of ``(event_id, ts, user_id, value)``.

    State is kept per group of users (``USER_GROUPS`` of them by hash, as a group for every user would mostly hold a row
    or two) and span of time: the rows still waiting and those of the hour before the watermark. It
    is removed once the watermark has passed the span. Rows of a span's last hour are also sent to the next span,
    as history, so a busy user's backlog is spread over one group per span: with spans of two hours a group holds at
    most three hours of its users, however many events they have. Rows later than the delay are dropped by the
    watermark.
    """
    span = span_hours * HOUR_S
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    at = F.unix_micros("ts") / F.lit(1000000.0)
    rows = timed.select("user_id", F.col("event_id").alias("id"), "ts", at.alias("at"), F.col("value").alias("amount"))
    place = rows.withColumn("span", F.floor(F.col("at") / span)).withColumn("until", (F.col("span") + 1) * span)
    copies = F.when(F.col("at") >= F.col("until") - HOUR_S, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sent = place.withColumn("copy", F.explode(copies)).select(
        "user_id", (F.col("span") + F.col("copy")).alias("span"), (F.col("until") + F.col("copy") * span).alias("until"),
        "id", "ts", "at", "amount", (F.col("copy") == 0).alias("native"),
    )
    grouped = sent.withColumn("users", F.pmod(F.xxhash64("user_id"), F.lit(USER_GROUPS)))
    return grouped.groupBy("users", "span", "until").applyInPandasWithState(
        _step, _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def stream_documents(spark: SparkSession, folder: str, suffix: str = ".txt", files_per_batch: int | None = None) -> DataFrame:
    """New text files below a folder as a stream of documents."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(folder)
    return as_documents(files, suffix)


def stream_ingest_docs(spark: SparkSession, folder: str, size: int = 512, overlap: int = 50, files_per_batch: int | None = None) -> DataFrame:
    """New text files as chunks, to be appended to a collection."""
    return chunk_documents(stream_documents(spark, folder, files_per_batch=files_per_batch), size, overlap)


def ingest_batches(chunks: DataFrame, path: str, progress: str, encoder=None) -> DataFrame:
    """Run a chunk stream over what has arrived; returns the stored collection.

    Every micro-batch is encoded (``encoder(rows, "content")`` adds ``embedding``) and written to
    ``path/batch=<number>`` in overwrite mode. The batch number comes from the stream's progress in ``progress``, so a
    batch that runs again after a crash or restart replaces what it wrote before: each file's chunks are stored once.
    A restart with the same ``progress`` takes only files that are new.
    """
    spark = chunks.sparkSession

    def store(batch: DataFrame, number: int) -> None:
        rows = encoder(batch, "content") if encoder else batch
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    query = chunks.writeStream.foreachBatch(store).option("checkpointLocation", progress).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(path)

"""Streams fed file by file, with late and disordered rows, against the table operators."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomwork.operators.transactions import velocity_1h_by_user
from loomwork.session import fresh_path
from loomwork.streaming import alerts
from loomwork.streaming.run import append_now, file_stream, upsert_now
from loomwork.streaming.scoring import stream_ingest_docs, stream_velocity

START = dt.datetime(2024, 1, 1)
SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def feed(spark, batches):
    """Each batch as one file, in order."""
    import os
    import time

    path = fresh_path(spark, "feed").replace("file:", "")
    os.makedirs(path)
    for number, rows in enumerate(batches):
        out = f"{path}/b{number}.parquet"
        frame = pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value"])
        frame["ts"] = frame["ts"].astype("datetime64[us]").dt.tz_localize("UTC")
        frame.to_parquet(out, index=False)
        stamp = time.time() - 1000 + number
        os.utime(out, (stamp, stamp))
    return file_stream(spark, path, "*.parquet", spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def rows_of(n=400, seed=0):
    rng = np.random.default_rng(seed)
    at = np.sort(rng.integers(0, 12 * 3600, n))
    return [(i, START + dt.timedelta(seconds=int(s)), int(u), "click" if u % 2 else "view", float(v))
            for i, (s, u, v) in enumerate(zip(at, np.where(rng.random(n) < 0.5, 1, rng.integers(0, 9, n)), rng.integers(1, 100, n)))]


@pytest.mark.parametrize("span", [1, 3, None])
def test_velocity_equals_the_table_with_disordered_input(spark, span):
    """User 1 holds half of all rows over twelve hours: with short spans it is dealt over many state groups."""
    rows = rows_of()
    rng = np.random.default_rng(1)
    # delay each row's arrival by less than the watermark
    arrival = sorted(rows, key=lambda r: r[1] + dt.timedelta(seconds=int(rng.integers(0, 3000))))
    last = [(10_000, START + dt.timedelta(days=30), 99, "view", 1.0)]  # moves the watermark past everything
    batches = [arrival[i:i + 60] for i in range(0, len(arrival), 60)] + [last, [(10_001, START + dt.timedelta(days=31), 99, "view", 1.0)]]
    events = feed(spark, batches).select("event_id", "ts", "user_id", "value")
    got = append_now(stream_velocity(events, span_hours=span) if span else stream_velocity(events)).toPandas()
    table = spark.createDataFrame([(r[0], (r[1] - START).total_seconds(), r[4], r[2]) for r in rows], "id bigint, time_s double, amount double, user_id bigint")
    want = velocity_1h_by_user(table).toPandas()
    both = want.merge(got, on="id", suffixes=("", "_stream"))
    assert len(both) == len(rows)
    assert (both["velocity_count_1h"] == both["velocity_count_1h_stream"]).all()
    assert np.allclose(both["velocity_amount_1h"], both["velocity_amount_1h_stream"])


def test_rows_later_than_the_watermark_are_dropped(spark):
    early, late = START, START + dt.timedelta(hours=10)
    batches = [[(1, early, 1, "view", 1.0)], [(2, late, 1, "view", 1.0)], [(3, early, 1, "view", 5.0)], [(4, late + dt.timedelta(hours=5), 1, "view", 1.0)]]
    got = {r["id"]: r["velocity_count_1h"] for r in append_now(stream_velocity(feed(spark, batches).select("event_id", "ts", "user_id", "value"))).collect()}
    assert 3 not in got and got[1] == 0 and got[2] == 0


def test_counters_over_several_batches(spark):
    rows = rows_of(300)
    got = upsert_now(alerts.event_counters(feed(spark, [rows[:100], rows[100:200], rows[200:]])), ["window_start", "event_type"]).toPandas()
    want = alerts.event_counters(spark.createDataFrame(rows, SCHEMA)).toPandas()
    order = ["window_start", "event_type", "n"]
    assert got[order].sort_values(order).values.tolist() == want[order].sort_values(order).values.tolist()


def test_latency_sketch_is_near_the_exact_value(spark):
    rows = rows_of(3000, seed=5)
    sketch = upsert_now(alerts.latency_windows(feed(spark, [rows])), ["window_start"]).toPandas().set_index("window_start")["p95"]
    exact = alerts.latency_windows_exact(spark.createDataFrame(rows, SCHEMA)).toPandas().set_index("window_start")["p95"]
    assert set(sketch.index) == set(exact.index)
    assert (np.abs(sketch - exact) <= 60).all() and np.median(np.abs(sketch - exact)) < 10


def test_alert_needs_two_windows_in_a_row(spark):
    windows = spark.createDataFrame([(0, 9.0), (300, 9.0), (900, 9.0), (1200, 1.0)], "window_start bigint, p95 double")
    got = {r["window_start"]: r["alert"] for r in alerts.held_alerts(windows, 5.0).collect()}
    assert got == {0: False, 300: True, 900: False, 1200: False}


def test_freshness(spark):
    rows = [(1, START, 1, "view", 1.0), (2, START + dt.timedelta(hours=1), 1, "view", 1.0)]
    newest = alerts.newest_event(feed(spark, [rows[1:], rows[:1]])).withColumn("one", F.lit(1))
    as_of = (START + dt.timedelta(hours=40) - dt.datetime(1970, 1, 1)).total_seconds()
    r = alerts.freshness(upsert_now(newest, ["one"]), as_of).first()
    assert r["age_hours"] == pytest.approx(39) and r["stale"]


def test_new_files_are_appended_as_chunks(spark, tmp_path):
    folder, progress, out = tmp_path / "in", str(tmp_path / "progress"), str(tmp_path / "out")
    (folder / "sub").mkdir(parents=True)
    (folder / "a.txt").write_text("One. " * 30)

    def run():
        stream = stream_ingest_docs(spark, str(folder), 64, 8)
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.parquet(out)

    first = run().count()
    (folder / "sub" / "b.txt").write_bytes(b"Two \xff. " * 30)
    rows = run().toPandas()
    assert first > 1 and len(rows) > first and set(rows["filename"]) == {"a.txt", "b.txt"}
    assert rows[rows["filename"] == "b.txt"]["content"].str.contains("�").all()


def test_ingest_stores_each_batch_once_across_restarts(spark, tmp_path):
    from loomwork.operators.vectors import hash_encoder
    from loomwork.streaming.scoring import ingest_batches

    folder, progress, out = tmp_path / "in", str(tmp_path / "progress"), str(tmp_path / "out")
    folder.mkdir()
    for i in range(3):
        (folder / f"d{i}.txt").write_text(f"Document {i}. " * 40)
    seed = spark.createDataFrame([("Document one two three.",)], "content string")
    encoder = hash_encoder(seed, "content", dim=16)
    first = ingest_batches(stream_ingest_docs(spark, str(folder), 64, 8, files_per_batch=1), out, progress, encoder)
    n_first = first.count()
    assert first.select("batch").distinct().count() == 3 and first.where("size(embedding) = 16").count() == n_first
    # a restart with the same progress takes only the new file
    (folder / "d3.txt").write_text("Document 3. " * 40)
    second = ingest_batches(stream_ingest_docs(spark, str(folder), 64, 8, files_per_batch=1), out, progress, encoder)
    rows = second.toPandas()
    assert len(rows) == n_first + n_first // 3
    assert not rows.duplicated(["filename", "chunk_index"]).any()
    # a batch that runs again writes over itself
    again = spark.read.parquet(f"{out}/batch=0")
    again.write.mode("overwrite").parquet(f"{tmp_path}/copy")
    spark.read.parquet(f"{tmp_path}/copy").write.mode("overwrite").parquet(f"{out}/batch=0")
    assert spark.read.parquet(out).count() == len(rows)


def test_velocity_keeps_few_state_groups(spark):
    from loomwork.streaming.scoring import USER_GROUPS

    rows = [(i, START + dt.timedelta(seconds=i), i, "view", 1.0) for i in range(200)]  # 200 users of one row
    last = [(999, START + dt.timedelta(minutes=30), 1, "view", 1.0)]
    events = feed(spark, [rows, last]).select("event_id", "ts", "user_id", "value")
    writer = stream_velocity(events).writeStream.format("parquet").option("path", fresh_path(spark, "v"))
    query = writer.option("checkpointLocation", fresh_path(spark, "p")).trigger(availableNow=True).start()
    query.awaitTermination()
    held = [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators]
    assert 0 < max(held) <= USER_GROUPS

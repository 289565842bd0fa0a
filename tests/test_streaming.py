"""Streams against their batch counterparts, late rows, restarts, and the split."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators.messages import STREAM_ALIASES
from tidemark.session import scratch_dir
from tidemark.sources.messages import read_event_stream
from tidemark.streaming import sinks
from tidemark.streaming.metrics import decode_events, dropped_by_watermark, minute_counts
from tidemark.sinks import storage
from tidemark.streaming.sinks import write_stream_split, write_stream_upsert

T0 = datetime(2024, 1, 1, 10)
NOW = {"availableNow": True}
FILE_SCHEMA = "value STRING, timestamp TIMESTAMP"


def message(kind="view", snake=False, **extra):
    names = ("user_id", "event_type") if snake else ("userId", "eventType")
    return json.dumps({names[0]: "u", names[1]: kind, **extra})


def send(spark, path, rows):
    """One more file of (value, broker time)."""
    spark.createDataFrame(rows, FILE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, source, root):
    stream = read_event_stream(spark, "parquet", FILE_SCHEMA, path=source)
    query = write_stream_upsert(
        minute_counts(decode_events(stream)), f"{root}/table", f"{root}/checkpoint", trigger=NOW
    )
    query.awaitTermination()
    return query


def table(spark, root):
    df = spark.read.parquet(f"{root}/table")
    return {(r.window_start, r.event_type): r.event_count for r in df.collect()}


def test_updates_late_rows_and_restart(spark):
    source, root = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    send(spark, source, [(message(), T0), (message("buy", snake=True), T0 + timedelta(seconds=59))])
    run(spark, source, root)
    assert table(spark, root) == {(T0, "view"): 1, (T0, "buy"): 1}

    # Out of order but within two minutes: counted, by a restarted query.
    send(spark, source, [(message(), T0 + timedelta(minutes=1)), (message(), T0)])
    run(spark, source, root)
    assert table(spark, root)[(T0, "view")] == 2

    send(spark, source, [(message(), T0 + timedelta(minutes=30))])
    run(spark, source, root)
    # The watermark has passed: dropped from state.
    send(spark, source, [(message(), T0), (message(), T0 + timedelta(minutes=30))])
    query = run(spark, source, root)
    assert dropped_by_watermark(query.recentProgress) == 1
    got = table(spark, root)
    assert got[(T0, "view")] == 2
    assert got[(T0 + timedelta(minutes=30), "view")] == 2

    # Nothing new: nothing counted twice.
    run(spark, source, root)
    assert table(spark, root) == got
    assert spark.read.parquet(f"{root}/table").count() == len(got)


def test_malformed_messages_stay_one_group(spark):
    source, root = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    for _ in range(2):
        send(spark, source, [("broken", T0), ("[1]", T0)])
        run(spark, source, root)
    assert table(spark, root) == {(T0, None): 4}


def test_many_batches_equal_one_batch(spark):
    source, root = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    rows = [
        (message("view" if i % 3 else "buy"), T0 + timedelta(seconds=7 * i)) for i in range(200)
    ]
    for part in range(4):
        send(spark, source, rows[part * 50 : part * 50 + 50])
        run(spark, source, root)
    batch = minute_counts(decode_events(spark.createDataFrame(rows, FILE_SCHEMA)))
    want = {(r.window_start, r.event_type): r.event_count for r in batch.collect()}
    assert table(spark, root) == want


def test_decoder_reads_both_spellings_and_bytes(spark):
    texts = [
        message(productId=3, timestamp="2024-01-01T09:00:00Z"),
        message(snake=True, product_id=4),
        message(productId="x"),
    ]
    rows = [(bytearray(t.encode()), T0) for t in texts]
    raw = spark.createDataFrame(rows, "value BINARY, timestamp TIMESTAMP")
    got = decode_events(raw).collect()
    assert [(r.user_id, r.event_type, r.product_id) for r in got] == [
        ("u", "view", 3),
        ("u", "view", 4),
        ("u", "view", None),
    ]
    assert got[0].event_time == datetime(2024, 1, 1, 9) and got[0].kafka_ts == T0


def test_split_writes_each_message_once(spark):
    source, root = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    texts = [message(), message("bad"), "broken", message(snake=True), "{}"]
    send(spark, source, [(t, T0) for t in texts])

    def split(checkpoint):
        stream = read_event_stream(spark, "parquet", FILE_SCHEMA, path=source)
        write_stream_split(
            stream, f"{root}/valid", f"{root}/dlq", checkpoint, ("view",), NOW
        ).awaitTermination()

    # The second run repeats batch 0, as after a failure before the commit.
    split(f"{root}/c1")
    storage.delete(spark, f"{root}/c1/commits/0")
    split(f"{root}/c1")
    valid = spark.read.parquet(f"{root}/valid")
    assert valid.count() == 2
    # Another stream adds its messages and overwrites nothing.
    split(f"{root}/c2")
    valid = spark.read.parquet(f"{root}/valid")
    assert valid.count() == 4 and valid.select("stream").distinct().count() == 2
    assert {json.loads(r.value)["timestamp"] for r in valid.collect()} == {
        "2024-01-01T10:00:00.000000"
    }
    reasons = {r.reason for r in spark.read.parquet(f"{root}/dlq").collect()}
    assert reasons == {
        "invalid_event_type: bad",
        "invalid_json",
        "missing_required: event_type, user_id",
    }
    decoded = decode_events(valid.withColumn("timestamp", F.col("timestamp"))).collect()
    assert {r.event_type for r in decoded} == {"view"}
    assert STREAM_ALIASES["user_id"] == "userId"


def test_jdbc_feed_appends_changed_windows_and_skips_empty_batches(spark, monkeypatch):
    """No database here: the append itself is replaced by a Parquet one."""
    source, root = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    calls = []

    def append(df, url, table, properties):
        calls.append((url, table, properties))
        df.write.mode("append").parquet(f"{root}/feed")

    monkeypatch.setattr(sinks, "jdbc_append", append)

    def feed():
        stream = read_event_stream(spark, "parquet", FILE_SCHEMA, path=source)
        sinks.write_stream_jdbc(
            minute_counts(decode_events(stream)), "jdbc:x", "live", {}, f"{root}/checkpoint", NOW
        ).awaitTermination()

    send(spark, source, [(message(), T0), (message(), T0)])
    feed()
    send(spark, source, [(message(), T0)])
    feed()
    feed()
    assert calls == [("jdbc:x", "live", {})] * 2
    counts = sorted(r.event_count for r in spark.read.parquet(f"{root}/feed").collect())
    assert counts == [2, 3]

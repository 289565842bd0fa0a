"""The stream that keeps late rows, against Spark's own watermark, and batches that repeat."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.session import scratch_dir
from tidemark.sinks import tables
from tidemark.sources.messages import read_event_stream
from tidemark.streaming import late
from tidemark.streaming.metrics import decode_events, dropped_by_watermark, minute_counts
from tidemark.streaming.sinks import write_stream_upsert

T0 = datetime(2024, 1, 1, 10)
NOW = {"availableNow": True}
FILES = "value STRING, timestamp TIMESTAMP"


def minute(n, seconds=0):
    return T0 + timedelta(minutes=n, seconds=seconds)


def send(spark, source, rows):
    values = [(f'{{"eventType": "{k}"}}', t) for k, t in rows]
    spark.createDataFrame(values, FILES).coalesce(1).write.mode("append").parquet(source)


def run(spark, source, root):
    stream = read_event_stream(spark, "parquet", FILES, path=source)
    query = late.write_stream_counts(
        decode_events(stream), f"{root}/totals", f"{root}/late", f"{root}/marks", f"{root}/checkpoint", trigger=NOW
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def totals(spark, root):
    return {(r.window_start, r.event_type): r.event_count for r in spark.read.parquet(f"{root}/totals").collect()}


def behind(spark, root):
    return sorted((r.kafka_ts, r.event_type, r.watermark) for r in spark.read.parquet(f"{root}/late").collect())


BATCHES = [
    [("view", minute(0)), ("buy", minute(0, 59)), ("view", minute(1))],
    [("view", minute(0, 30)), ("view", minute(10))],
    # The watermark is 8 minutes past: a window that ends there is closed, the next one is open.
    [("view", minute(7, 59)), ("view", minute(8)), ("buy", minute(0)), ("view", minute(9))],
    [("buy", minute(3)), ("view", minute(10, 1))],
]


def test_divides_rows_as_sparks_watermark_does(spark):
    source, root = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    other, progress = scratch_dir(spark, "other"), []
    for rows in BATCHES:
        send(spark, source, rows)
        run(spark, source, root)
        stream = read_event_stream(spark, "parquet", FILES, path=source)
        query = write_stream_upsert(
            minute_counts(decode_events(stream)), f"{other}/table", f"{other}/checkpoint", trigger=NOW
        )
        query.awaitTermination()
        progress += query.recentProgress
    want = {(r.window_start, r.event_type): r.event_count for r in spark.read.parquet(f"{other}/table").collect()}
    assert totals(spark, root) == want
    assert behind(spark, root) == [
        (minute(0), "buy", minute(8)), (minute(3), "buy", minute(8)), (minute(7, 59), "view", minute(8))
    ]
    # Spark counts dropped groups after its partial aggregation; here each group is one row.
    assert dropped_by_watermark(progress) == 3
    assert sum(want.values()) + 3 == sum(map(len, BATCHES))


@pytest.mark.parametrize("step", ["counts", "marks"])
def test_a_batch_that_fails_halfway_is_repeated_once(spark, monkeypatch, step):
    source, root = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    for rows in BATCHES[:2]:
        send(spark, source, rows)
        run(spark, source, root)
    send(spark, source, BATCHES[2])
    held_upsert, held_mark = late.upsert_table, late.next_mark

    def fail(*args, **kwargs):
        if step == "marks":
            raise OSError("lost")
        held_upsert(*args, **kwargs)
        raise OSError("lost")

    # After the counts are written, or after the late rows and the counts, before the mark.
    monkeypatch.setattr(late, "upsert_table" if step == "counts" else "next_mark", fail)
    with pytest.raises(Exception, match="lost"):
        run(spark, source, root)
    monkeypatch.setattr(late, "upsert_table", held_upsert)
    monkeypatch.setattr(late, "next_mark", held_mark)
    run(spark, source, root)
    assert totals(spark, root) == {
        (minute(0), "view"): 2, (minute(0), "buy"): 1, (minute(1), "view"): 1, (minute(10), "view"): 1,
        (minute(8), "view"): 1, (minute(9), "view"): 1,
    }
    assert [r[:2] for r in behind(spark, root)] == [(minute(0), "buy"), (minute(7, 59), "view")]


def test_counts_of_a_repeated_batch_start_from_before_it(spark):
    stored = spark.createDataFrame(
        [(T0.date(), T0, None, minute(1), 5, 2, "s/1"), (T0.date(), T0, "x", minute(1), 7, 0, "s/0")],
        schemas.WINDOW_TOTALS,
    )
    new = stored.select("window_date", "window_start", "window_end", "event_type", F.lit(3).cast("long").alias("event_count"))
    once = {r.event_type: (r.event_count, r.count_before) for r in late.add_counts(stored, new, "s/1").collect()}
    assert once == {None: (5, 2), "x": (10, 7)}


def test_a_new_stream_adds_to_the_same_tables(spark):
    source, root = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    send(spark, source, [("view", minute(30))])
    run(spark, source, root)
    # Another checkpoint has no watermark yet, and batch numbers that begin anew.
    again = scratch_dir(spark, "in2")
    send(spark, again, [("view", minute(0)), ("view", minute(30))])
    stream = read_event_stream(spark, "parquet", FILES, path=again)
    late.write_stream_counts(
        decode_events(stream), f"{root}/totals", f"{root}/late", f"{root}/marks", f"{root}/checkpoint2", trigger=NOW
    ).awaitTermination()
    assert totals(spark, root) == {(minute(30), "view"): 2, (minute(0), "view"): 1}
    assert behind(spark, root) == [] and tables.read_or_empty(spark, f"{root}/marks", schemas.LATE_MARKS).count() == 2

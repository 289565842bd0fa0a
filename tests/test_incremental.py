"""Rollups of changed hours, clustered files, and the state of streams."""

from __future__ import annotations

import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import changes, clustering, reports
from tidemark.plans import batch, incremental
from tidemark.plans.lake import Lake
from tidemark.session import scratch_dir
from tidemark.sources.messages import read_event_stream
from tidemark.streaming import health
from tidemark.streaming.metrics import decode_events, first_copies, minute_counts
from tidemark.streaming.sinks import write_stream_upsert

DAY = datetime(2024, 1, 1)
FILES = "value STRING, timestamp TIMESTAMP"


def events(spark, rows):
    full = [(i, u, k, None, None, None, t) for i, u, k, t in rows]
    return spark.createDataFrame(full, schemas.EVENTS)


def hour(n):
    return DAY + timedelta(hours=n)


def stored(spark, lake):
    df = spark.read.parquet(lake.gold(incremental.HOURS_TABLE))
    return {(r.hour_start, r.event_type): r.total_count for r in df.select("hour_start", "event_type", "total_count").collect()}


def files(spark, lake):
    df = spark.read.parquet(lake.gold(incremental.HOURS_TABLE)).select("_metadata.file_path", "dt").distinct()
    return {r.dt: r.file_path for r in df.collect()}


def test_only_changed_hours_are_counted_again(spark):
    lake = Lake(scratch_dir(spark, "dirty"))
    rows = [(i, "u", "view" if i % 3 else "buy", hour(i % 30)) for i in range(300)]
    incremental.extract_noted(events(spark, rows), lake, (DAY, hour(48)))
    assert incremental.rollup_changed_hours(spark, lake) == 48
    assert sum(stored(spark, lake).values()) == 300
    before = files(spark, lake)
    assert incremental.rollup_changed_hours(spark, lake) == 0 and files(spark, lake) == before
    # Hour 5 gets a late row, hour 6 loses all of its rows.
    late = [*rows, (999, "u", "view", hour(5))]
    incremental.extract_noted(events(spark, [r for r in late if r[3] != hour(6)]), lake, (hour(5), hour(7)))
    assert incremental.rollup_changed_hours(spark, lake) == 2
    after = files(spark, lake)
    assert {d for d in before if after.get(d) != before[d]} == {DAY.date()} and len(before) == 2
    counts = stored(spark, lake)
    assert counts[(hour(5), "view")] + counts.get((hour(5), "buy"), 0) == 11
    assert not any(h == hour(6) for h, _ in counts)
    # The days' shares equal those of a full run.
    whole = lake.events(spark, (DAY, hour(48)))
    want = reports.daily_event_summary(whole, (DAY, hour(48)))
    columns = ("report_date", "event_hour", "event_type", "event_count", "pct_of_daily")
    got = spark.read.parquet(lake.gold(incremental.SHARES_TABLE))
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_a_write_that_dies_and_a_rollup_that_dies(spark, monkeypatch):
    lake = Lake(scratch_dir(spark, "dying"))
    first = events(spark, [(1, "u", "view", hour(1))])
    incremental.extract_noted(first, lake, (DAY, hour(3)))
    incremental.rollup_changed_hours(spark, lake)
    # The rows arrive, the note after them does not; the note before them is enough.
    held = batch.extract

    def dies(*args):
        held(*args)
        raise OSError("lost")

    monkeypatch.setattr(batch, "extract", dies)
    more = events(spark, [(1, "u", "view", hour(1)), (2, "u", "view", hour(1))])
    with pytest.raises(OSError, match="lost"):
        incremental.extract_noted(more, lake, (hour(1), hour(2)))
    monkeypatch.setattr(batch, "extract", held)
    # A rollup that dies before its marks is repeated.
    upsert = incremental.tables.upsert_table
    monkeypatch.setattr(incremental.tables, "upsert_table", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        incremental.rollup_changed_hours(spark, lake)
    monkeypatch.setattr(incremental.tables, "upsert_table", upsert)
    assert incremental.rollup_changed_hours(spark, lake) == 1
    assert stored(spark, lake) == {(hour(1), "view"): 2}
    assert incremental.rollup_changed_hours(spark, lake) == 0


def test_a_change_during_a_rollup_stays_dirty(spark):
    at = [datetime(2024, 2, 1, 0, m) for m in range(4)]
    log = spark.createDataFrame([(hour(1), at[0]), (hour(1), at[2]), (hour(2), at[1])], schemas.CHANGES)
    marks = spark.createDataFrame([(DAY.date(), hour(1), at[1]), (DAY.date(), hour(2), at[1])], schemas.CHANGE_MARKS)
    assert [tuple(r) for r in changes.dirty_hours(log, marks).collect()] == [(hour(1), at[2])]
    assert changes.dirty_hours(log, marks.limit(0)).count() == 2
    assert changes.dirty_hours(log.limit(0), marks).isEmpty()


def test_long_backlogs_are_done_in_rounds_of_whole_days(monkeypatch):
    monkeypatch.setattr(incremental, "ROUND", 30)
    from pyspark.sql import Row

    dirty = [Row(hour_start=hour(n), changed_at=DAY) for n in range(24 * 5)]
    parts = list(incremental._rounds(dirty))
    assert [len(p) for p in parts] == [48, 48, 24] and sum(parts, []) == dirty
    assert list(incremental._rounds([])) == []


# -- clustered files ----------------------------------------------------------


def test_bits_are_interleaved(spark):
    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a INT, b INT")
    got = {(r.a, r.b): r.z for r in df.select("a", "b", clustering.interleave(F.col("a"), F.col("b"), 3).alias("z")).collect()}
    for (a, b), z in got.items():
        assert z == sum(((a >> i) & 1) << (2 * i + 1) | ((b >> i) & 1) << (2 * i) for i in range(3))


def test_a_read_opens_few_files_and_finds_every_row(spark):
    path = scratch_dir(spark, "curve")
    rows = [(i, None if i % 97 == 0 else f"u{(i * i) % 211}", "view", None if i % 101 == 0 else hour(i % 700)) for i in range(20_000)]
    df = events(spark, rows)
    clustering.write_clustered(df, path, 36)
    index = spark.read.parquet(clustering.index_path(path))
    assert index.count() >= 30 and index.agg(F.sum("rows")).first()[0] == len(rows)
    iv, users = (hour(100), hour(160)), ["u4", "u9", "absent"]
    chosen = clustering.files_of(index, iv, users)
    assert 0 < len(chosen) < index.count() / 4
    found = clustering.read_users(spark, path, df.schema, iv, users)
    want = df.filter(F.col("user_id").isin(users) & (F.col("created_at") >= hour(100)) & (F.col("created_at") < hour(160)))
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in want.collect()) != []
    assert sorted(spark.read.parquet(path).select("id").toPandas()["id"]) == list(range(20_000))
    assert clustering.read_users(spark, path, df.schema, iv, []).isEmpty()
    assert clustering.read_users(spark, path, df.schema, ("2030-01-01", "2030-01-02"), users).isEmpty()


def test_a_file_of_two_far_squares_is_opened_only_for_its_rows(spark):
    path = scratch_dir(spark, "joined")
    early = [(i, "u1", "view", hour(i)) for i in range(300)]
    late = [(300 + i, "u2", "view", hour(600 + i)) for i in range(300)]
    df = events(spark, [*early, *late, (600, "u2", "view", hour(450)), (601, "u1", "view", None)])
    clustering.write_clustered(df, path, 1)
    index = spark.read.parquet(clustering.index_path(path))
    assert (index.count(), index.first().rows) == (1, 602)
    start, end = (hour(0), hour(100)), (hour(600), hour(700))
    assert len(clustering.files_of(index, start, ["u1"])) == len(clustering.files_of(index, end, ["u2"])) == 1
    assert clustering.files_of(index, end, ["u1"]) == clustering.files_of(index, start, ["u2"]) == []
    assert clustering.read_users(spark, path, df.schema, end, ["u1"]).isEmpty()
    assert clustering.read_users(spark, path, df.schema, start, ["u1"]).count() == 100
    # The ranges of the whole file, all that older tables have, still find every row.
    assert len(clustering.files_of(index.drop("boxes"), start, ["u1"])) == 1


def test_five_users_without_common_files_still_open_few(spark):
    path = scratch_dir(spark, "spread")
    df = events(spark, [(i, f"u{(i * i) % 1511}", "view", hour(i % 720)) for i in range(20_000)])
    clustering.write_clustered(df, path, 64)
    index = spark.read.parquet(clustering.index_path(path)).cache()
    iv = (hour(4 * 24), hour(11 * 24))
    reached = {f"u{u}": set(clustering.files_of(index, iv, [f"u{u}"])) for u in range(30)}
    most = 0
    for first in reached:
        # The other four each add as many files as can be.
        users, opened = [first], set(reached[first])
        for _ in range(4):
            users.append(max(reached, key=lambda u: len(reached[u] - opened)))
            opened |= reached[users[-1]]
        most = max(most, len(opened))
    assert opened == set(clustering.files_of(index, iv, users))
    assert index.count() >= 60 and 3 * most < index.count()


def test_clustering_one_moment_and_no_rows(spark):
    path = scratch_dir(spark, "moment")
    df = events(spark, [(i, f"u{i % 50}", "view", DAY) for i in range(500)])
    clustering.write_clustered(df, path, 8)
    iv = (DAY, hour(1))
    assert clustering.read_users(spark, path, df.schema, iv, ["u3"]).count() == 10
    empty = scratch_dir(spark, "none")
    clustering.write_clustered(df.limit(0), empty, 8)
    assert clustering.read_users(spark, empty, df.schema, iv, ["u3"]).isEmpty()


# -- streams ------------------------------------------------------------------


def send(spark, source, rows):
    values = [(json.dumps({"userId": u, "eventType": "view"}), t) for u, t in rows]
    spark.createDataFrame(values, FILES).coalesce(1).write.mode("append").parquet(source)


def test_copies_are_dropped_before_they_are_counted(spark):
    source, root = scratch_dir(spark, "in"), scratch_dir(spark, "out")

    def run():
        stream = read_event_stream(spark, "parquet", FILES, path=source)
        counts = minute_counts(first_copies(decode_events(stream)), watermark=None)
        write_stream_upsert(counts, f"{root}/t", f"{root}/c", trigger={"availableNow": True}, state_partitions=2).awaitTermination()
        return {r.window_start: r.event_count for r in spark.read.parquet(f"{root}/t").collect()}

    second = timedelta(seconds=1)
    rows = [("u", DAY), ("u", DAY + second / 2), ("u", DAY + second), ("v", DAY), (None, DAY), (None, DAY)]
    send(spark, source, rows)
    assert run() == {DAY: 4}
    # Copies of an earlier run, within the watermark, and a row of its own.
    send(spark, source, [("u", DAY + second / 4), ("v", DAY), ("w", DAY), ("w", DAY + 60 * second)])
    assert run() == {DAY: 5, DAY + 60 * second: 1}
    table = spark.createDataFrame([(u, "view", t) for u, t in rows], "user_id STRING, event_type STRING, kafka_ts TIMESTAMP")
    assert first_copies(table).count() == 4


def test_progress_and_state_of_a_stream(spark):
    source, root = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    log = health.ProgressLog(spark, f"{root}/progress")
    assert health.read_progress(spark, f"{root}/progress").isEmpty()
    send(spark, source, [("u", DAY), ("v", DAY + timedelta(minutes=10)), ("w", DAY + timedelta(minutes=10, seconds=5))])
    spark.streams.addListener(log)
    try:
        stream = read_event_stream(spark, "parquet", FILES, path=source)
        query = write_stream_upsert(
            minute_counts(decode_events(stream)), f"{root}/t", f"{root}/c", trigger={"availableNow": True}, state_partitions=2
        )
        query.awaitTermination()
        for _ in range(100):
            if health.read_progress(spark, f"{root}/progress").filter("watermark > '2000-01-01'").count():
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    row = health.latest_progress(health.read_progress(spark, f"{root}/progress"), "2024-01-01T01:00").first()
    assert row.total_input_rows == 3 and row.watermark == DAY + timedelta(minutes=8, seconds=5)
    assert row.watermark_delay_s == 3600 - 485 and row.total_dropped_late == 0
    state = health.window_state(spark, f"{root}/c")
    assert [tuple(r) for r in state.collect()] == [
        (DAY + timedelta(minutes=10), DAY + timedelta(minutes=11), "view", 2)
    ]
    found = health.state_health(state, "2024-01-01T01:00").first()
    assert (found.state_rows, found.open_events, found.oldest_age_s) == (1, 2, 3000)
    stores = health.state_stores(spark, f"{root}/c").first()
    assert stores.operator == "stateStoreSave" and stores.stores == 2
    none = health.state_health(state.limit(0), "2024-01-01").first()
    assert (none.state_rows, none.open_events, none.oldest_age_s) == (0, 0, None)

"""Offset ranges of the dead-letter read: plans, options, gaps, and runs that fail."""

from __future__ import annotations

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans import checks
from tidemark.plans.lake import Lake
from tidemark.session import scratch_dir
from tidemark.sinks import exports
from tidemark.sources import messages, offsets

BOUNDS = "partition INT, earliest BIGINT, latest BIGINT"


@pytest.fixture
def plan(spark):
    def make(done, bounds, limit=None):
        found = offsets.plan_offsets(
            spark.createDataFrame(done, schemas.REPLAY_OFFSETS),
            spark.createDataFrame(bounds, BOUNDS),
            limit,
        )
        assert found.schema.simpleString() == schemas.OFFSET_PLAN.simpleString()
        return sorted(found.collect())

    return make


def test_every_kind_of_partition(plan):
    done = [(0, 40), (1, 100), (2, 5), (3, 900), (5, 7)]
    bounds = [(0, 0, 90), (1, 0, 100), (2, 30, 60), (3, 0, 20), (4, 11, 12)]
    found = plan(done, bounds)
    assert [tuple(r) for r in found] == [
        (0, 40, 90, 0, "lagging"),
        (1, 100, 100, 0, "idle"),
        (2, 30, 60, 25, "gap"),
        (3, 0, 20, 0, "reset"),
        (4, 11, 12, 0, "new"),
        (5, 7, 7, 0, "vanished"),
    ]
    options = offsets.offset_options(found, "dlq")
    assert json.loads(options["startingOffsets"]) == {"dlq": {"0": 40, "1": 100, "2": 30, "3": 0, "4": 11}}
    assert json.loads(options["endingOffsets"]) == {"dlq": {"0": 90, "1": 100, "2": 60, "3": 20, "4": 12}}
    # They replace the bounds of the whole topic.
    merged = messages.kafka_batch_options("b:1", "dlq", **options)
    assert merged["startingOffsets"] == options["startingOffsets"] and merged["subscribe"] == "dlq"


def test_a_bounded_plan_takes_partitions_in_order(plan):
    bounds = [(0, 0, 10), (1, 5, 25), (2, 0, 10)]
    assert [(r.starting, r.ending) for r in plan([(1, 8)], bounds, 15)] == [(0, 10), (8, 13), (0, 0)]
    assert [(r.starting, r.ending) for r in plan([], bounds, 0)] == [(0, 0), (5, 5), (0, 0)]
    assert plan([], [], 5) == [] and plan([], []) == []


def test_gaps_and_progress(spark, plan):
    rows = plan([(0, 5), (1, 3), (7, 1)], [(0, 9, 20), (1, 0, 4)], 12)
    frame = spark.createDataFrame(rows, schemas.OFFSET_PLAN)
    assert [tuple(r) for r in offsets.offset_gaps(frame).collect()] == [(0, 5, 9, 4)]
    assert sorted(tuple(r) for r in offsets.reached_offsets(frame).collect()) == [(0, 20), (1, 4)]


def test_a_file_read_takes_the_planned_ranges(spark, plan):
    path = scratch_dir(spark, "ranges")
    rows = [(p, o, f"{p}-{o}") for p in range(3) for o in range(0, 30, 1 + p)]
    spark.createDataFrame(rows, schemas.DLQ_MESSAGES).write.parquet(path)
    bounds = messages.dlq_bounds(spark, "parquet", path=path)
    assert sorted(tuple(r) for r in bounds.collect()) == [(0, 0, 30), (1, 0, 29), (2, 0, 28)]
    taken = plan([(0, 12), (1, 29), (2, 3)], [(0, 0, 30), (1, 0, 29), (2, 0, 28)])
    df = messages.read_dlq(spark, "parquet", plan=taken, path=path)
    want = [r for r in rows if (r[0] == 0 and r[1] >= 12) or (r[0] == 2 and r[1] >= 3)]
    assert sorted(tuple(r) for r in df.collect()) == want
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,3)" in text and "LessThan(offset,30)" in text
    assert messages.read_dlq(spark, "parquet", plan=[], path=path).isEmpty()


class FakeKafka:
    """The few classes of the JVM that a look at a topic's bounds needs."""

    def __init__(self):
        self.settings, self.closed = {}, False
        deserialized = SimpleNamespace(TopicPartition=lambda t, p: FakePartition(t, p))
        self.org = SimpleNamespace(apache=SimpleNamespace(kafka=SimpleNamespace(
            clients=SimpleNamespace(consumer=SimpleNamespace(KafkaConsumer=lambda _: self)),
            common=deserialized,
        )))
        put = SimpleNamespace(put=self.settings.__setitem__)
        self.java = SimpleNamespace(util=SimpleNamespace(Properties=lambda: put))

    def partitionsFor(self, topic):
        return [SimpleNamespace(partition=lambda p=p: p) for p in (0, 1)]

    def beginningOffsets(self, parts):
        return {p: 10 * p.number for p in parts}

    def endOffsets(self, parts):
        return {p: 100 + p.number for p in parts}

    def close(self):
        self.closed = True


class FakePartition:
    def __init__(self, topic, number):
        self.number = number

    def partition(self):
        return self.number


def test_bounds_of_a_topic_come_from_its_broker(spark):
    jvm = FakeKafka()
    fake = SimpleNamespace(_jvm=jvm, createDataFrame=spark.createDataFrame)
    found = offsets.topic_bounds(fake, "b:1", "dlq", **{"kafka.security.protocol": "SSL", "minPartitions": "8"})
    assert sorted(tuple(r) for r in found.collect()) == [(0, 0, 100), (1, 10, 101)]
    assert jvm.closed and jvm.settings["bootstrap.servers"] == "b:1"
    assert jvm.settings["security.protocol"] == "SSL" and "minPartitions" not in jvm.settings


def letters(spark, path, rows):
    good = [(p, o, json.dumps({"user_id": "u", "event_type": k})) for p, o, k in rows]
    spark.createDataFrame(good, schemas.DLQ_MESSAGES).write.mode("append").parquet(path)


def replay(spark, lake, source, target, **more):
    checks.replay_dead_letters(
        spark, lake, "2024-01-31", "parquet", "text", {"path": source}, {"path": target}, **more
    )


def stored_offsets(spark, lake):
    return sorted(tuple(r) for r in spark.read.parquet(lake.table("dlq_replay_offsets")).collect())


def test_replay_goes_on_where_it_stopped(spark):
    lake = Lake(scratch_dir(spark, "offsets"))
    source, target = f"{lake.root}/dlq", f"{lake.root}/main"
    letters(spark, source, [(0, o, "view" if o % 3 else "bad") for o in range(10)])
    replay(spark, lake, source, target, max_messages=4)
    assert stored_offsets(spark, lake) == [(0, 4)] and spark.read.text(target).count() == 2
    letters(spark, source, [(1, o, "view") for o in range(3)])
    replay(spark, lake, source, target)
    assert stored_offsets(spark, lake) == [(0, 10), (1, 3)] and spark.read.text(target).count() == 9
    replay(spark, lake, source, target)
    assert spark.read.text(target).count() == 9
    log = spark.read.parquet(lake.log("dlq_unrecoverable_log"))
    assert sorted(r.kafka_offset for r in log.collect()) == [0, 3, 6, 9]


def test_a_run_that_fails_between_log_and_republish(spark, monkeypatch):
    lake = Lake(scratch_dir(spark, "failing"))
    source, target = f"{lake.root}/dlq", f"{lake.root}/main"
    letters(spark, source, [(0, o, "view" if o % 2 else "bad") for o in range(6)])
    held = exports.republish

    def fail(*_, **__):
        raise OSError("broker gone")

    monkeypatch.setattr(exports, "republish", fail)
    with pytest.raises(OSError, match="broker gone"):
        replay(spark, lake, source, target)
    monkeypatch.setattr(exports, "republish", held)
    # The log is written, the offsets are not: the next run logs nothing twice and republishes.
    assert spark.read.parquet(lake.log("dlq_unrecoverable_log")).count() == 3
    replay(spark, lake, source, target)
    assert spark.read.parquet(lake.log("dlq_unrecoverable_log")).count() == 3
    assert spark.read.text(target).count() == 3 and stored_offsets(spark, lake) == [(0, 6)]


def test_messages_lost_to_retention_are_logged_once(spark):
    lake = Lake(scratch_dir(spark, "lost"))
    source, target = f"{lake.root}/dlq", f"{lake.root}/main"
    letters(spark, source, [(0, o, "view") for o in range(4)])
    replay(spark, lake, source, target)
    # Retention leaves offsets from 9 on.
    later = f"{lake.root}/dlq-later"
    letters(spark, later, [(0, o, "view") for o in range(9, 12)])
    replay(spark, lake, later, target)
    replay(spark, lake, later, target)
    gaps = spark.read.parquet(lake.log("dlq_offset_gap_log"))
    assert [(r.partition, r.from_offset, r.to_offset, r.lost) for r in gaps.collect()] == [(0, 4, 9, 5)]
    assert spark.read.text(target).count() == 7 and gaps.filter(F.col("noticed_at").isNull()).isEmpty()

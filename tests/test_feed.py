"""The relational feed against a stand-in for the database, with failures at every step.

No database can run here: the statements are checked as text, and a small transactional stand-in
carries them out by what they are.
"""

from __future__ import annotations

import copy
from collections import Counter
from datetime import datetime, timedelta

import pytest

from tidemark.session import scratch_dir
from tidemark.sources.messages import read_event_stream
from tidemark.streaming import feed as feeds
from tidemark.streaming.metrics import decode_events, minute_counts

T0 = datetime(2024, 1, 1, 10)
FEED = feeds.Feed("jdbc:x", "live", ("window_start", "event_type", "event_count", "batch_id"))


class Database:
    """Tables in memory. A connection works on a copy, which its commit puts in place."""

    def __init__(self):
        self.tables = {"live": [], "staging": [], "ledger": {}}
        self.fail_at, self.stage_twice = None, False
        self.log = []

    def connect(self, spark, feed):
        return Session(self, feed)

    def stage(self, rows, feed):
        found = [r.asDict() for r in rows.collect()]
        self.step("stage")
        self.tables["staging"] += found * (2 if self.stage_twice else 1)

    def step(self, name):
        self.log.append(name)
        if self.fail_at == name:
            self.fail_at = None
            raise OSError(f"lost at {name}")


class Session:
    def __init__(self, database, feed):
        self.database, self.feed = database, feed
        self.tables = copy.deepcopy(database.tables)

    def execute(self, statement, *values):
        feed, staging = self.feed, self.tables["staging"]
        own = [r for r in staging if (r["query_id"], r["batch_id"]) == values[:2]]
        if statement == feed.known:
            return int(values in self.tables["ledger"])
        if statement == feed.enter:
            self.database.step("enter")
            if values[:2] in self.tables["ledger"]:
                raise KeyError("primary key")
            self.tables["ledger"][values[:2]] = values[2]
            return 1
        if statement == feed.move:
            self.database.step("move")
            rows = {tuple(r[c] for c in feed.columns) for r in own if r["attempt"] == values[2]}
            self.tables["live"] += sorted(rows)
            return len(rows)
        assert statement == feed.clear
        self.database.step("clear")
        self.tables["staging"] = [r for r in staging if r not in own]
        return len(own)

    def commit(self):
        self.database.step("commit")
        self.database.tables = self.tables

    def rollback(self):
        self.tables = copy.deepcopy(self.database.tables)

    def close(self):
        self.database.log.append("close")


def batch(spark):
    rows = [(T0, "view", 3, 4), (T0, "buy", 1, 4)]
    return spark.createDataFrame(rows, "window_start TIMESTAMP, event_type STRING, event_count BIGINT, batch_id BIGINT")


def publish(spark, database, number=4):
    return feeds.publish_batch(batch(spark), FEED, "q", number, database.connect, database.stage)


def test_statements():
    assert FEED.move == (
        "INSERT INTO live (window_start, event_type, event_count, batch_id)"
        " SELECT DISTINCT window_start, event_type, event_count, batch_id FROM live_staging"
        " WHERE query_id = ? AND batch_id = ? AND attempt = ?"
    )
    assert FEED.clear == "DELETE FROM live_staging WHERE query_id = ? AND batch_id = ?"
    assert FEED.enter == "INSERT INTO live_batches (query_id, batch_id, row_count) VALUES (?, ?, ?)"
    ledger, staging = FEED.definitions
    assert "PRIMARY KEY (query_id, batch_id)" in ledger and staging.startswith("CREATE TABLE live_staging")


def test_a_repeated_batch_moves_nothing(spark):
    database = Database()
    assert publish(spark, database) and not publish(spark, database)
    assert len(database.tables["live"]) == 2 and database.tables["staging"] == []
    assert database.tables["ledger"] == {("q", 4): 2}
    # The ledger and the rows are one transaction, after the stage.
    assert database.log[:9] == ["clear", "commit", "close", "stage", "enter", "move", "clear", "commit", "close"]
    assert publish(spark, database, 5) and len(database.tables["live"]) == 4


@pytest.mark.parametrize("step", ["stage", "enter", "move", "clear", "commit"])
@pytest.mark.parametrize("later", [False, True])
def test_a_failure_at_any_step_leaves_each_row_once(spark, step, later):
    database = Database()
    if later and step in ("clear", "commit"):
        # The second use of the step: within the transaction that moves the rows.
        once = database.step

        def second(name, seen=Counter()):
            seen[name] += 1
            if name == step and seen[name] == 2:
                database.fail_at = name
            once(name)

        database.step = second
    else:
        database.fail_at = step
    with pytest.raises(OSError, match=f"lost at {step}"):
        publish(spark, database)
    assert database.tables["live"] == [] and database.tables["ledger"] == {}
    assert publish(spark, database)
    assert len(database.tables["live"]) == 2 and database.tables["staging"] == []


def test_rows_staged_twice_are_moved_once_and_missing_ones_are_noticed(spark):
    database = Database()
    database.stage_twice = True
    assert publish(spark, database) and len(database.tables["live"]) == 2
    short = Database()
    short.stage = lambda rows, feed: Database.stage(short, rows.limit(1), feed)
    with pytest.raises(RuntimeError, match="1 of 2 rows"):
        publish(spark, short)
    assert short.tables["live"] == [] and short.tables["ledger"] == {}


def test_a_stream_that_fails_between_ledger_and_commit_goes_on(spark):
    source, checkpoint = scratch_dir(spark, "in"), scratch_dir(spark, "checkpoint")
    database = Database()

    def run():
        stream = read_event_stream(spark, "parquet", "value STRING, timestamp TIMESTAMP", path=source)
        query = feeds.write_stream_feed(
            minute_counts(decode_events(stream)), FEED, checkpoint, {"availableNow": True}, database.connect, database.stage
        )
        query.awaitTermination()

    def send(*times):
        rows = [('{"eventType": "view"}', t) for t in times]
        spark.createDataFrame(rows, "value STRING, timestamp TIMESTAMP").write.mode("append").parquet(source)

    send(T0, T0)
    database.fail_at = "move"
    with pytest.raises(Exception, match="lost at move"):
        run()
    assert database.tables["live"] == []
    run()
    send(T0, T0 + timedelta(minutes=1))
    run()
    run()
    rows = [(start, n) for start, _, n, _ in database.tables["live"]]
    assert sorted(rows) == [(T0, 2), (T0, 3), (T0 + timedelta(minutes=1), 1)]
    assert sorted(database.tables["ledger"].values()) == [1, 2]

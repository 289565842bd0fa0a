"""Feed of micro-batches to a relational table that takes every batch once.

The rows of a batch go to a staging table first, in parallel and under a token of this
attempt. Then one transaction enters the batch into a ledger, moves the attempt's rows to the
target and clears the stage. The ledger's key is (query id, batch id), so a batch that is
repeated after a failure finds itself there and moves nothing, and of two drivers that run the
same batch one fails on the key. A task that Spark runs twice stages its rows twice; the move
takes distinct rows and must find as many as the batch has, or everything is rolled back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks.exports import jdbc_append
from tidemark.streaming.sinks import start_batches, stream_id


class Connection(Protocol):
    """One connection without autocommit. `execute` gives the number of rows it changed, or
    for a query the first column of its first row."""

    def execute(self, statement: str, *values: Any) -> int: ...
    def commit(self) -> None: ...
    def rollback(self) -> None: ...
    def close(self) -> None: ...


@dataclass(frozen=True)
class Feed:
    """A target table with the staging and ledger tables beside it."""

    url: str
    table: str
    columns: tuple[str, ...]
    properties: dict[str, str] = field(default_factory=dict)

    @property
    def staging(self) -> str:
        return f"{self.table}_staging"

    @property
    def ledger(self) -> str:
        return f"{self.table}_batches"

    @property
    def definitions(self) -> tuple[str, str]:
        """Statements for whoever sets up the database; types of the target's columns as there."""
        names = ", ".join(self.columns)
        return (
            f"CREATE TABLE {self.ledger} (query_id VARCHAR(64) NOT NULL, batch_id BIGINT NOT NULL,"
            " row_count BIGINT NOT NULL, PRIMARY KEY (query_id, batch_id))",
            f"CREATE TABLE {self.staging} AS SELECT {names}, query_id, batch_id, attempt"
            f" FROM {self.table} CROSS JOIN (SELECT query_id, batch_id, query_id AS attempt"
            f" FROM {self.ledger}) keys WHERE 1 = 0",
        )

    @property
    def known(self) -> str:
        return f"SELECT COUNT(*) FROM {self.ledger} WHERE query_id = ? AND batch_id = ?"

    @property
    def enter(self) -> str:
        return f"INSERT INTO {self.ledger} (query_id, batch_id, row_count) VALUES (?, ?, ?)"

    @property
    def move(self) -> str:
        names = ", ".join(self.columns)
        return (
            f"INSERT INTO {self.table} ({names}) SELECT DISTINCT {names} FROM {self.staging}"
            " WHERE query_id = ? AND batch_id = ? AND attempt = ?"
        )

    @property
    def clear(self) -> str:
        return f"DELETE FROM {self.staging} WHERE query_id = ? AND batch_id = ?"


class JdbcConnection:
    """A connection of the driver's JVM."""

    def __init__(self, spark: SparkSession, feed: Feed) -> None:
        jvm = spark._jvm
        properties = jvm.java.util.Properties()
        for key, value in feed.properties.items():
            properties.put(key, value)
        if "driver" in feed.properties:
            # Drivers that came with --jars are known to Spark's registry only.
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(
                feed.properties["driver"]
            )
        self._held = jvm.java.sql.DriverManager.getConnection(feed.url, properties)
        self._held.setAutoCommit(False)

    def execute(self, statement: str, *values: Any) -> int:
        prepared = self._held.prepareStatement(statement)
        try:
            for place, value in enumerate(values, 1):
                prepared.setObject(place, value)
            if not prepared.execute():
                return prepared.getUpdateCount()
            rows = prepared.getResultSet()
            return rows.getLong(1) if rows.next() else 0
        finally:
            prepared.close()

    def commit(self) -> None:
        self._held.commit()

    def rollback(self) -> None:
        self._held.rollback()

    def close(self) -> None:
        self._held.close()


def stage_rows(rows: DataFrame, feed: Feed) -> None:
    jdbc_append(rows, feed.url, feed.staging, feed.properties)


def publish_batch(
    rows: DataFrame,
    feed: Feed,
    query: str,
    batch_id: int,
    connect: Callable[[SparkSession, Feed], Connection] = JdbcConnection,
    stage: Callable[[DataFrame, Feed], None] = stage_rows,
) -> bool:
    """Bring a batch into the target; False if it was there already. The rows are distinct."""
    spark, key, attempt = rows.sparkSession, (query, batch_id), uuid.uuid4().hex
    connection = connect(spark, feed)
    try:
        if connection.execute(feed.known, *key):
            return False
        # What an attempt before this one has left behind.
        connection.execute(feed.clear, *key)
        connection.commit()
    finally:
        connection.close()
    named = rows.select(*feed.columns).withColumns(
        {"query_id": F.lit(query), "batch_id": F.lit(batch_id).cast("long"), "attempt": F.lit(attempt)}
    )
    number = rows.count()
    stage(named, feed)
    # A new connection: staging may take longer than a database keeps an idle one.
    connection = connect(spark, feed)
    try:
        connection.execute(feed.enter, *key, number)
        moved = connection.execute(feed.move, *key, attempt)
        if moved != number:
            raise RuntimeError(f"batch {batch_id}: {moved} of {number} rows were staged")
        connection.execute(feed.clear, *key)
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()
    return True


def write_stream_feed(
    stream: DataFrame,
    feed: Feed,
    checkpoint: str,
    trigger: dict | None = None,
    connect: Callable[[SparkSession, Feed], Connection] = JdbcConnection,
    stage: Callable[[DataFrame, Feed], None] = stage_rows,
) -> StreamingQuery:
    """Append every changed window to a relational table, each batch once.

    A window that changes in several batches has several rows; the feed's columns should
    contain `batch_id`, by which a reader takes the newest. Empty batches are left out.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("long")).persist()
        try:
            if not rows.isEmpty():
                query = stream_id(rows.sparkSession, checkpoint)
                publish_batch(rows, feed, query, batch_id, connect, stage)
        finally:
            rows.unpersist()

    return start_batches(stream, write, "update", checkpoint, trigger)

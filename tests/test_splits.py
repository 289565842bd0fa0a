"""Split predicates: every row in exactly one, and none much larger than the mean."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.sources import splits

T0 = datetime(2024, 1, 1)


def sizes(df, predicates):
    cases = [F.expr(p).cast("int").alias(f"p{i}") for i, p in enumerate(predicates)]
    flags = df.select([F.coalesce(c, F.lit(0)).alias(f"p{i}") for i, c in enumerate(cases)])
    total = sum(F.col(f"p{i}") for i in range(len(cases)))
    assert flags.filter(total != 1).isEmpty()
    row = flags.agg(*(F.sum(f"p{i}").alias(f"p{i}") for i in range(len(cases)))).first()
    return [row[i] for i in range(len(cases))]


@pytest.mark.parametrize("kind", ["even", "dense end", "clusters", "few", "negative"])
def test_numbers_are_split_by_rows(spark, kind):
    rng = random.Random(7)
    values = {
        "even": range(10_000),
        "dense end": [*range(0, 10**9, 10**6), *range(10**9, 10**9 + 9000)],
        "clusters": [c * 10**12 + rng.randrange(10**4) for c in (0, 5, 6, 900) for _ in range(2500)],
        "few": [5, 5, 7, None],
        "negative": [-(10**10) + i * i for i in range(5000)],
    }[kind]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, None, None])], "k BIGINT, id BIGINT")
    column = splits.SplitColumn("id")
    known = [v for v in values if v is not None]
    predicates = splits.split_predicates(splits.frame_counts(df, column), column, min(known), max(known) + 1, 16)
    got = sizes(df, predicates)
    assert predicates[-1] == "id IS NULL" and got[-1] == len(list(values)) + 2 - len(known)
    if kind != "few":
        assert len(predicates) <= 26 and max(got[:-1]) <= 2 * len(known) / 16


def test_rows_beyond_the_counted_bounds_are_read(spark):
    df = spark.createDataFrame([(v,) for v in range(1000)], "id BIGINT")
    column = splits.SplitColumn("id")
    predicates = splits.split_predicates(splits.frame_counts(df.filter("id >= 100 AND id < 900"), column), column, 100, 900, 4)
    assert sum(sizes(df, predicates)) == 1000
    assert "AND" not in predicates[0] and predicates[0].startswith("id < ")
    assert "AND" not in predicates[-2] and predicates[-2].startswith("id >= ")


def test_times_and_a_value_with_most_rows(spark):
    rows = [(i, T0 + timedelta(days=i % 30, microseconds=i)) for i in range(2000)]
    rows += [(i, T0 + timedelta(days=3)) for i in range(-3000, 3000)] + [(None, T0 + timedelta(days=3)), (1, None)]
    df = spark.createDataFrame(rows, "id BIGINT, at TIMESTAMP")
    column = splits.SplitColumn("at", is_time=True)
    low, high = column.number(T0), column.number(T0 + timedelta(days=31))
    counts = splits.frame_counts(df, column)
    whole = sizes(df, splits.split_predicates(counts, column, low, high, 8))
    assert max(whole) >= 6000
    spread = splits.split_predicates(counts, column, low, high, 8, spread="id")
    assert max(sizes(df, spread)) <= 2 * 8002 / 8
    assert any("TIMESTAMP '2024-01-04 00:00:00.000000'" in p for p in spread)


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "id BIGINT")
    column = splits.SplitColumn("id")
    assert splits.split_predicates(splits.frame_counts(df, column), column, 0, 10, 4) == ["id IS NOT NULL", "id IS NULL"]


def test_count_query_of_a_database():
    column = splits.SplitColumn("created_at", is_time=True)
    text = splits.count_query("raw_events", column, "MICROS({0})", column.number(T0), column.number(T0) + 10, 5)
    assert text == (
        "SELECT FLOOR((MICROS(created_at) - (1704067200000000)) / 5) AS b, COUNT(*) AS n FROM raw_events"
        " WHERE created_at >= TIMESTAMP '2024-01-01 00:00:00.000000'"
        " AND created_at < TIMESTAMP '2024-01-01 00:00:00.000010'"
        " GROUP BY FLOOR((MICROS(created_at) - (1704067200000000)) / 5)"
    )

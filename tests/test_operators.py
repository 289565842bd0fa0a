"""Edge rules on small literal inputs."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.intervals import (
    bucket_count,
    date_spine,
    in_interval,
    month_interval,
    previous_day,
    previous_month,
    spine,
)
from tidemark.operators import (
    drift,
    duplicates,
    lifecycle,
    messages,
    monitoring,
    quality,
    reports,
    tenants,
)
from tidemark.sinks import tables

T0 = datetime(2024, 1, 1)
DAY = ("2024-01-01", "2024-01-02")


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def events(spark, rows):
    """Rows of (id, user_id, event_type, created_at[, product_id, payload])."""
    full = []
    for r in rows:
        id_, user, kind, when, *rest = r
        product = rest[0] if rest else 1
        payload = rest[1] if len(rest) > 1 else "{}"
        full.append((id_, user, kind, payload, product, None, when))
    return spark.createDataFrame(full, schemas.EVENTS)


def as_set(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


# -- intervals ----------------------------------------------------------------


def test_interval_keeps_start_and_drops_end(spark):
    df = events(spark, [(1, "a", "view", T0), (2, "a", "view", T0 + timedelta(days=1))])
    assert [r.id for r in df.filter(in_interval("created_at", DAY)).collect()] == [1]


def test_interval_with_zone_is_converted(spark):
    iv = ("2024-01-01T02:00:00+02:00", "2024-01-01T03:00:00+02:00")
    df = events(spark, [(1, "a", "view", T0), (2, "a", "view", T0 + timedelta(hours=2))])
    assert [r.id for r in df.filter(in_interval("created_at", iv)).collect()] == [1]


def test_bucket_count_covers_partial_buckets(spark):
    assert bucket_count(DAY, "1 hour") == 24
    assert bucket_count(("2024-01-01T00:30:00", "2024-01-01T02:00:01"), "1 hour") == 3
    assert bucket_count(("2024-01-01", "2024-01-01T00:00:00.000001"), "1 hour") == 1
    assert spine(spark, DAY, "2 hours").count() == 12


def test_calendar_helpers(spark):
    assert previous_month("2024-01-15") == "2023-12"
    assert previous_month("2024-03-31") == "2024-02"
    assert month_interval("2024-02") == (datetime(2024, 2, 1), datetime(2024, 3, 1))
    assert previous_day("2024-03-01T07:00:00")[0] == datetime(2024, 2, 29)
    days = [r.dt for r in date_spine(spark, "2024-02-28", 3, "dt").collect()]
    assert days == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]


# -- validation ---------------------------------------------------------------


def test_drop_nulls_counts_in_the_same_pass(spark):
    df = events(
        spark,
        [(1, "a", "view", T0), (2, None, "view", T0), (3, "b", None, T0), (4, None, None, T0)],
    )
    clean, counts = quality.drop_nulls(df, ["user_id", "event_type"])
    assert [r.id for r in clean.collect()] == [1]
    assert counts.get == {"total": 4, "dropped": 3}


def test_keep_allowed_drops_null_and_unknown(spark):
    df = events(spark, [(1, "a", "view", T0), (2, "a", None, T0), (3, "a", "VIEW", T0)])
    kept = quality.keep_allowed(df, "event_type", ["view", "purchase"])
    assert [r.id for r in kept.collect()] == [1]


@pytest.mark.parametrize(("rows", "fails"), [(20, True), (21, False)])
def test_null_gate_threshold(spark, rows, fails):
    data = [(i, "a" if i else None, "view", T0 + timedelta(seconds=i)) for i in range(rows)]
    df = events(spark, data)
    hours = ("2024-01-01", "2024-01-01T02:00:00")
    rates = {r.window_start: r for r in quality.null_rate(df, iv=hours).collect()}
    assert len(rates) == 2
    assert rates[T0].quarantine is fails
    assert (rates[T0].total_rows, rates[T0].null_rows) == (rows, 1)
    empty = rates[T0 + timedelta(hours=1)]
    assert (empty.null_pct, empty.quarantine, empty.total_rows) == (0.0, False, 0)
    for iv in (hours, None):
        bad = quality.null_quarantine(df, iv=iv).collect()
        assert [r.event_id for r in bad] == ([0] if fails else [])


def test_row_count_sla_reports_every_hour(spark):
    data = [(i, "a", "view", T0 + timedelta(hours=1, seconds=i)) for i in range(9)]
    data += [(100 + i, "a", "view", T0 + timedelta(hours=2, seconds=i)) for i in range(10)]
    got = quality.row_count_sla(events(spark, data), ("2024-01-01", "2024-01-01T03:00:00"))
    result = [(r.row_count, r.sla_passed) for r in got.orderBy("window_start").collect()]
    assert result == [(0, False), (9, False), (10, True)]


# -- duplicates ---------------------------------------------------------------


def duplicate_rows():
    return [
        (1, "a", "view", at("2024-01-01T10:00:00.100000")),
        (2, "a", "view", at("2024-01-01T10:00:00.900000")),
        (3, "a", "view", at("2024-01-01T10:00:01")),
        (4, None, "view", at("2024-01-01T10:00:00")),
        (5, None, "view", at("2024-01-01T10:00:00.500000")),
        (6, "a", None, at("2024-01-01T10:00:00")),
        (7, "a", None, None),
        (8, "a", None, None),
    ]


def test_duplicate_rank(spark):
    df = events(spark, duplicate_rows())
    ranks = {r.event_id: r.rn for r in duplicates.duplicate_rank(df).collect()}
    assert ranks == {1: 1, 2: 2, 3: 1, 4: 1, 5: 2, 6: 1, 7: 1, 8: 2}
    assert {r.event_id for r in duplicates.duplicate_audit(df).collect()} == {2, 5, 8}
    assert {r.id for r in duplicates.deduplicate(df).collect()} == {1, 3, 4, 6, 7}
    counted = duplicates.duplicate_counts(df).filter("window_start IS NOT NULL").first()
    assert (counted.total_rows, counted.duplicate_count) == (6, 2)


@pytest.mark.parametrize("bound", [7, 1 << 20])
@pytest.mark.parametrize("spread", ["dense", "sparse", "clustered"])
def test_hot_groups_are_ranked_exactly(spark, spread, bound):
    """One second holds most rows, half of them in one group; ranks match a plain count."""
    ids = {
        "dense": list(range(300)),
        "sparse": [(i * 7919) ** 3 % (2**62) for i in range(1, 301)],
        "clustered": list(range(280)) + [2**60 + i for i in range(20)],
    }[spread]
    rows = []
    for n, id_ in enumerate(ids):
        user = None if n % 2 else f"u{n % 6}"
        when = T0 if n % 10 else T0 + timedelta(seconds=n)
        rows.append((id_, user, "view", when))
    expected, seen = {}, {}
    for id_, user, kind, when in sorted(rows):
        seen[(user, kind, when)] = seen.get((user, kind, when), 0) + 1
        expected[id_] = seen[(user, kind, when)]
    ranked = duplicates.duplicate_rank(events(spark, rows), bound=bound)
    assert {r.event_id: r.rn for r in ranked.collect()} == expected
    copies = duplicates.duplicate_audit(events(spark, rows), bound=bound)
    assert {r.event_id: r.rn for r in copies.collect()} == {i: n for i, n in expected.items() if n > 1}


def test_only_crowded_cells_are_split(spark):
    """Cells of few groups stay whole; the sum over crowded cells bounds the ranges."""
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"))
    found = duplicates.crowded_cells(df, "k", 50).collect()
    assert len(found) == 1 and 400 <= found[0]["_rows"] < 450
    assert duplicates.crowded_cells(df.filter("id >= 400"), "k", 50).isEmpty()
    # With a single cell, everything is suspect.
    assert duplicates.crowded_cells(df, "k", 50, cells=1).first()["_rows"] == 1000


def test_a_hot_group_is_split_whatever_its_ids(spark):
    """One group, ids in two far clusters: no range holds much more than its share."""
    ids = list(range(20_000)) + [2**60 + i for i in range(50)]
    rows = [(i, "u", "view", T0) for i in ids]
    df = events(spark, rows).repartition(4).select("id", F.struct("user_id", "event_type").alias("_key"))
    # Small ranges would be merged again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = duplicates.key_ranges(df, "_key", "id").groupBy("_range").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in ranged]
    assert len(sizes) >= 4 and max(sizes) < 2 * len(ids) / len(sizes)


def test_promotion_to_bronze(spark):
    df = events(spark, duplicate_rows())
    bronze = quality.promote_to_bronze(df, allowed=("view",))
    assert {r.id for r in bronze.collect()} == {1, 3}


# -- drift --------------------------------------------------------------------


def test_drift_with_types_on_one_side_only(spark):
    rows = [(i, "a", "new" if i < 5 else "view", at("2024-01-15T01:00:00")) for i in range(10)]
    rows += [(100 + i, "a", "old" if i < 2 else "view", at("2024-01-09")) for i in range(10)]
    rows += [(900, "a", "old", at("2024-01-07T23:59:59")), (901, "a", "old", at("2024-01-16"))]
    found = drift.distribution_drift(events(spark, rows), "2024-01-15")
    assert as_set(found, "event_type", "today_pct", "baseline_pct", "deviation") == {
        ("new", 50.0, 0.0, 50.0),
        ("old", 0.0, 20.0, 20.0),
        ("view", 50.0, 80.0, 30.0),
    }
    audit = drift.drift_audit(found, "2024-01-15").first()
    assert (audit.drift_detected, audit.max_deviation_pct) == (True, 50.0)
    assert audit.today_dist == '{"new":50.0,"view":50.0}'
    assert audit.baseline_dist == '{"old":20.0,"view":80.0}'


@pytest.mark.parametrize(("share", "drifted"), [(60, True), (59, False)])
def test_drift_of_exactly_ten_points(spark, share, drifted):
    rows = [(i, "a", "x" if i < share else "y", at("2024-01-15")) for i in range(100)]
    rows += [(200 + i, "a", "x" if i < 50 else "y", at("2024-01-10")) for i in range(100)]
    found = drift.distribution_drift(events(spark, rows), "2024-01-15")
    assert drift.drift_audit(found, "2024-01-15").first().drift_detected is drifted


def test_drift_without_events(spark):
    found = drift.distribution_drift(events(spark, []), "2024-01-15")
    audit = drift.drift_audit(found, "2024-01-15").first()
    assert (audit.drift_detected, audit.max_deviation_pct) == (False, 0.0)
    assert (audit.today_dist, audit.baseline_dist) == ("{}", "{}")


def test_schema_drift_classes(spark):
    kind = "col_name STRING, data_type STRING"
    actual = spark.createDataFrame(
        [("id", "string"), ("uid", "string"), ("event_type", "string")], kind
    )
    expected = spark.createDataFrame(
        [("id", "bigint"), ("user_id", "string"), ("event_type", "string")], kind
    )
    found = drift.schema_drift(actual, expected)
    assert as_set(found, "col_name", "status") == {
        ("id", "type_mismatch"),
        ("uid", "extra"),
        ("user_id", "missing"),
    }
    record = drift.schema_drift_record(found, F.current_timestamp()).first()
    assert (record.drift_detected, record.missing_cols, record.extra_cols) == (
        True,
        ["user_id"],
        ["uid"],
    )
    assert record.type_mismatches == '{"id":{"expected":"bigint","actual":"string"}}'
    same = drift.schema_drift_record(
        drift.schema_drift(expected, expected), F.current_timestamp()
    ).first()
    assert (same.drift_detected, same.missing_cols, same.type_mismatches) == (False, [], "{}")


def test_payload_keys(spark):
    rows = [
        (1, "a", "view", T0, 1, '{"product_id": 1, "amount": 2}'),
        (2, "a", "view", T0, 1, '{"product_id": null, "note": "x"}'),
        (3, "a", "view", T0, 1, "broken"),
        (4, "a", "view", T0, 1, None),
    ]
    found = drift.payload_key_drift(events(spark, rows), ("product_id", "amount", "currency"))
    assert as_set(found, "key", "present_rows", "presence_pct", "status") == {
        ("product_id", 2, 50.0, "partial"),
        ("amount", 1, 25.0, "partial"),
        ("currency", 0, 0.0, "missing"),
        ("note", 1, 25.0, "extra"),
    }


# -- messages -----------------------------------------------------------------

LONG = '{"user_id": "' + "x" * 3000

CASES = [
    ('{"user_id": "a", "event_type": "vi', "invalid_json"),
    ("[1]", "invalid_json"),
    ('"x"', "invalid_json"),
    ("null", "invalid_json"),
    ("", "invalid_json"),
    (None, "invalid_json"),
    ("{'user_id': 'a', 'event_type': 'view'}", "invalid_json"),
    ('{"user_id": "a", "event_type": "view"} tail', "invalid_json"),
    ('{"user_id": "a", "event_type": "view"} {"more": 1}', "invalid_json"),
    ('{"user_id": "a", "event_type": "view"}}', "invalid_json"),
    ('{"user_id": "a", "event_type": "view"}], [{"b": 1}', "invalid_json"),
    ('{"user_id": "a", "event_type": "view"}, "v": {"b": 1}', "invalid_json"),
    ('{"event_type": "view"}', "missing_required: user_id"),
    ("{}", "missing_required: event_type, user_id"),
    ('{"userId": "a", "eventType": "view"}', "missing_required: event_type, user_id"),
    ('{"user_id": "a", "event_type": "VIEW"}', "invalid_event_type: VIEW"),
    ('{"user_id": "a", "event_type": null}', "invalid_event_type: None"),
    ('{"user_id": null, "event_type": "view"}', None),
    ('  {"user_id": "a", "event_type": "view"}\n', None),
    ('{"user_id": "}{", "event_type": "view", "n": {"a": [1, "]"]}}', None),
    (LONG, "invalid_json"),
]


def raw_messages(spark, texts):
    return spark.createDataFrame(
        [(0, i, t) for i, t in enumerate(texts)], schemas.DLQ_MESSAGES
    )


def test_classification(spark):
    raw = raw_messages(spark, [c[0] for c in CASES])
    got = messages.classify_messages(raw, as_of="2024-01-31").orderBy("offset").collect()
    assert [r.reason for r in got] == [c[1] for c in CASES]
    fixable, unrecoverable = messages.split_valid_dlq(
        messages.classify_messages(raw, as_of="2024-01-31")
    )
    assert fixable.count() + unrecoverable.count() == len(CASES)
    logged = messages.unrecoverable_log(unrecoverable, messages.MAX_LOGGED_CHARS).collect()
    assert max(len(r.raw_value or "") for r in logged) == 2000
    whole = messages.unrecoverable_log(unrecoverable).collect()
    assert LONG in {r.raw_value for r in whole}


def test_very_long_text_is_read_whole(spark):
    long = F.concat(
        F.lit('{"user_id": "'), F.repeat(F.lit("x"), 21_000_000), F.lit('", "event_type": "')
    )
    raw = spark.range(2).select(
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.concat(long, F.when(F.col("id") == 0, 'view"}').otherwise('view"')).alias("value"),
    )
    got = messages.classify_messages(raw, as_of="2024-01-31").select("offset", "reason")
    assert as_set(got, "offset", "reason") == {(0, None), (1, "invalid_json")}


def test_repair_adds_only_absent_fields(spark):
    import json

    texts = [
        '{"user_id": "a", "event_type": "view"}',
        '{"user_id": "a", "event_type": "view", "product_id": 7, "x": [1, {"y": "}"}]} ',
        '{"user_id": "a", "event_type": "view", "timestamp": null}',
    ]
    raw = raw_messages(spark, texts)
    got = messages.classify_messages(raw, as_of="2024-01-31T01:02:03").orderBy("offset").collect()
    assert [json.loads(r.fixed_value) for r in got] == [
        {
            "user_id": "a",
            "event_type": "view",
            "product_id": None,
            "timestamp": "2024-01-31T01:02:03",
        },
        {
            "user_id": "a",
            "event_type": "view",
            "product_id": 7,
            "x": [1, {"y": "}"}],
            "timestamp": "2024-01-31T01:02:03",
        },
        {"user_id": "a", "event_type": "view", "timestamp": None, "product_id": None},
    ]


def test_stream_spelling_is_accepted_with_aliases(spark):
    raw = raw_messages(spark, ['{"userId": "a", "eventType": "view", "productId": 3}'])
    got = messages.classify_messages(
        raw, as_of="2024-01-31", aliases=messages.STREAM_ALIASES
    ).first()
    assert (got.reason, got.event_type) == (None, "view")
    assert "product" not in got.fixed_value.replace("productId", "")


# -- reports ------------------------------------------------------------------


def test_conversions_keep_the_null_product(spark):
    df = events(
        spark,
        [
            (1, "a", "purchase", T0, None),
            (2, "a", "purchase", T0, None),
            (3, "a", "purchase", T0, 5),
            (4, "a", "view", T0, 5),
            (5, "a", "purchase", T0 + timedelta(days=1), 5),
        ],
    )
    got = reports.product_conversions(df, DAY)
    assert as_set(got, "product_id", "total_conversions") == {(None, 2), (5, 1)}
    assert reports.product_conversions(df, ("2023-01-01", "2023-02-01")).isEmpty()


def test_daily_summary_shares(spark):
    one = reports.daily_event_summary(events(spark, [(1, "a", "view", T0)]), DAY).first()
    assert (one.event_hour, one.pct_of_daily) == (0, 100.0)
    # 1 of 800 is 0.125 %: half up gives 0.13.
    rows = [(i, "a", "x" if i == 0 else "y", T0 + timedelta(hours=23)) for i in range(800)]
    got = as_set(
        reports.daily_event_summary(events(spark, rows), DAY),
        "event_hour",
        "event_type",
        "pct_of_daily",
    )
    assert got == {(23, "x", 0.13), (23, "y", 99.88)}


def live(spark, rows):
    return spark.createDataFrame(
        [(s, s + timedelta(minutes=1), k, n, rec) for s, k, n, rec in rows], schemas.LIVE_METRICS
    )


def test_rollup_counts_a_window_once(spark):
    rows = [
        (T0, "view", 3, T0 + timedelta(seconds=10)),
        (T0, "view", 7, T0 + timedelta(seconds=40)),
        (T0 + timedelta(minutes=59), "view", 4, T0),
        (T0 + timedelta(hours=1), "view", 1, T0),
    ]
    got = reports.hourly_rollup(live(spark, rows), ("2024-01-01", "2024-01-01T01:00:00"))
    # 11 / 60 = 0.1833
    assert as_set(got, "hour_start", "total_count", "avg_per_minute") == {(T0, 11, 0.18)}


def user_rows(spark, rows):
    return spark.createDataFrame(rows, schemas.USERS)


def test_cohorts_start_on_monday_and_skip_deleted(spark):
    users = user_rows(
        spark,
        [
            ("sun", "", at("2024-01-07T23:59:59"), None),
            ("mon", "", at("2024-01-08"), None),
            ("gone", "", at("2024-01-08"), at("2024-01-09")),
            ("later", "", at("2024-01-08"), at("2025-01-01")),
        ],
    )
    assert as_set(reports.user_cohorts(users, "2024-02-01"), "user_id", "cohort_week") == {
        ("sun", date(2024, 1, 1)),
        ("mon", date(2024, 1, 8)),
        ("later", date(2024, 1, 8)),
    }


def test_weekly_metrics_window_and_joins(spark):
    users = user_rows(spark, [("a", "", T0, None), ("b", "", T0, None), ("c", "", T0, None)])
    cohorts = spark.createDataFrame(
        [("a", date(2024, 1, 1)), ("b", date(2024, 1, 1)), ("x", date(2024, 1, 1))],
        schemas.USER_COHORTS,
    )
    df = events(
        spark,
        [
            (1, "a", "view", at("2024-01-08")),
            (2, "a", "view", at("2024-01-14T23:59:59")),
            (3, "a", "view", at("2024-01-15")),
            (4, "b", "view", at("2024-01-10")),
            (5, "c", "view", at("2024-01-10")),
            (6, None, "view", at("2024-01-10")),
            (7, "x", "view", at("2024-01-10")),
        ],
    )
    got = reports.weekly_cohort_metrics(df, users, cohorts, "2024-01-15")
    assert as_set(got, "cohort_week", "report_week", "event_count", "unique_users") == {
        (date(2024, 1, 1), date(2024, 1, 15), 3, 2)
    }


def test_monthly_kpis_with_bad_amounts_and_changes(spark):
    def bought(i, user, when, amount):
        payload = "{}" if amount is None else '{"amount": ' + amount + "}"
        return (i, user, "purchase", at(when), 1, payload)

    df = events(
        spark,
        [
            bought(1, "a", "2024-01-05", None),
            bought(2, "a", "2024-01-06", "null"),
            bought(3, "b", "2024-01-07", '"abc"'),
            bought(4, None, "2024-01-08", '"1.2.3"'),
            bought(5, "c", "2024-01-31T23:59:59", "10"),
            bought(6, "c", "2024-03-01", "0.005"),
            (7, "c", "view", at("2024-01-02"), 1, '{"amount": 99}'),
        ],
    )
    got = reports.monthly_kpis(df, ["2024-01", "2024-02", "2024-03"]).orderBy("report_month")
    rows = [tuple(r) for r in got.collect()]
    assert rows == [
        ("2024-01", 5, 3, 10.0, False, None, None),
        ("2024-02", 0, 0, 0.0, True, -5, -10.0),
        ("2024-03", 1, 1, 0.01, False, 1, 0.01),
    ]
    stored = reports.storable_kpis(got)
    assert [r.report_month for r in stored.collect()] == ["2024-01", "2024-03"]
    lifted = df.withColumn("amount", F.get_json_object("payload", "$.amount").try_cast("decimal(12,2)"))
    again = reports.monthly_kpis(lifted, ["2024-01"], amount_col="amount").first()
    assert (again.total_purchases, again.avg_amount) == (5, 10.0)
    # Without a month list, only months with purchases exist and January is not March's neighbour.
    bare = reports.monthly_kpis(df).orderBy("report_month").collect()
    assert [(r.report_month, r.purchases_change) for r in bare] == [
        ("2024-01", None),
        ("2024-03", None),
    ]


@pytest.mark.parametrize(
    ("kinds", "critical"),
    [(["timeout"] * 5 + ["auth_error"], True), (["timeout"] * 1000, False), (["timeout"] * 1001, True)],
)
def test_error_windows(spark, kinds, critical):
    df = spark.createDataFrame(
        [(i, k, "", "", T0 + timedelta(minutes=119)) for i, k in enumerate(kinds)],
        schemas.INGESTION_ERRORS,
    )
    got = reports.error_summary(df).collect()
    assert {r.is_critical for r in got} == {critical}
    assert {r.window_start for r in got} == {T0}
    assert sum(r.error_count for r in got) == len(kinds)


# -- tenants ------------------------------------------------------------------


def manifest(spark, rows):
    return spark.createDataFrame(
        [(c, d, p) for p, (c, d) in enumerate(rows)],
        "client_id STRING, retention_days INT, position INT",
    )


def test_tenant_retention(spark):
    df = events(
        spark,
        [
            (1, "a", "purchase", at("2024-01-24"), 1),
            (2, "a", "purchase", at("2024-01-23T23:59:59"), 1),
            (3, "a", "view", at("2024-01-30"), 1),
            (4, "a", "purchase", at("2024-01-31"), 1),
        ],
    )
    both = df.withColumn("tenant", F.explode(F.array(F.lit("s"), F.lit("l"), F.lit("other"))))
    got = tenants.tenant_conversions(both, manifest(spark, [("s", 7), ("l", 90)]), "2024-01-31")
    assert as_set(got, "tenant_id", "product_id", "event_type", "total_conversions") == {
        ("s", 1, "purchase", 1),
        ("l", 1, "purchase", 2),
    }


def test_tenant_ranking_ties_and_zeros(spark):
    gold = spark.createDataFrame(
        [(1, "purchase", 2, "b"), (2, "view", 2, "b"), (1, "view", 4, "a"), (1, "view", 9, "zz")],
        schemas.TENANT_GOLD,
    )
    listed = manifest(spark, [("b", 1), ("none", 1), ("a", 1)])
    got = [tuple(r) for r in tenants.tenant_ranking(gold, listed).orderBy("rank").collect()]
    assert got == [(1, "b", 4, 2, 50.0), (2, "a", 4, 0, 0.0), (3, "none", 0, 0, 0.0)]
    row = tenants.cross_tenant_comparison(gold, listed, "2024-01-29").first()
    assert row.top_tenant == "b"
    assert row.details.startswith('{"report_week":"2024-01-29","tenants":[{"rank":1,"tenant":"b"')


def test_batch_tenant_join_is_full_and_null_safe(spark):
    batch = spark.createDataFrame(
        [(1, 4), (2, 5), (None, 2)], "product_id INT, total_conversions BIGINT"
    )
    gold = spark.createDataFrame(
        [(1, "purchase", 1, "a"), (1, "purchase", 1, "b"), (3, "purchase", 7, "a"), (None, "purchase", 1, "a")],
        schemas.TENANT_GOLD,
    )
    got = tenants.batch_tenant_join(batch, gold)
    assert as_set(got, "product_id", "batch_conversions", "tenant_conversions", "tenant_share") == {
        (1, 4, 2, 50.0),
        (2, 5, 0, 0.0),
        (3, 0, 7, None),
        (None, 2, 1, 50.0),
    }


# -- monitoring ---------------------------------------------------------------


@pytest.mark.parametrize(("lag", "met"), [(7200, True), (7201, False)])
def test_freshness_threshold(spark, lag, met):
    now = at("2024-01-31T12:00:00.500000")
    source = events(spark, [(1, "a", "view", now - timedelta(seconds=lag, milliseconds=400))])
    gold = spark.createDataFrame([(now,)], "modified_at TIMESTAMP")
    row = monitoring.freshness(source, gold, now).first()
    assert (row.source_lag_seconds, row.gold_lag_seconds) == (lag, 0)
    assert (row.e2e_lag_seconds, row.sla_met) == (lag, met)


def test_freshness_of_nothing(spark):
    empty = spark.createDataFrame([], "modified_at TIMESTAMP")
    row = monitoring.freshness(events(spark, []), empty, "2024-01-31").first()
    assert (row.source_lag_seconds, row.gold_lag_seconds, row.sla_met) == (999999, 999999, False)


def test_stream_health(spark):
    two = live(spark, [(T0, "view", 1, T0)])
    assert monitoring.stream_health(two, "2024-01-01T02:00:00").first().healthy is True
    assert monitoring.stream_health(two, "2024-01-01T02:00:01").first().healthy is False
    none = monitoring.stream_health(live(spark, []), "2024-01-01").first()
    assert (none.lag_hours, none.healthy) == (999.0, False)


def test_adaptive_mode(spark):
    def runs(name, counts):
        return [
            (name, T0 + timedelta(hours=i), n, "incremental", T0) for i, n in enumerate(counts)
        ]

    log = spark.createDataFrame(
        runs("short", [1, 1])
        + runs("low", [50, 9, 9, 9])
        + runs("edge", [9, 9, 10])
        + runs("old", [0, 0, 50, 9, 9]),
        schemas.RUN_LOG,
    )
    decided = monitoring.adaptive_mode(log)
    modes = {r.pipeline: r.mode for r in decided.collect()}
    assert modes == {
        "short": "incremental",
        "low": "full",
        "edge": "incremental",
        "old": "incremental",
    }
    iv = ("2024-01-05T06:00:00", "2024-01-05T07:00:00")
    spans = {
        r.pipeline: (r.start, r.end) for r in monitoring.adaptive_interval(decided, iv).collect()
    }
    assert spans["low"] == (datetime(2024, 1, 4), datetime(2024, 1, 5))
    assert spans["edge"] == (at(iv[0]), at(iv[1]))


@pytest.mark.parametrize(("failures", "escalates"), [(5, False), (6, True)])
def test_failure_audit(spark, failures, escalates):
    now = at("2024-01-31T12:00:00")
    rows = [
        ("d1", f"t{i % 2}", "failed", now - timedelta(hours=i), None, 1, 1, "h")
        for i in range(failures)
    ]
    rows += [
        ("d1", "t9", "failed", now - timedelta(hours=24, seconds=1), None, 1, 1, "h"),
        ("d2", "t1", "up_for_retry", now, None, 1, 1, "h"),
        ("d3", "t1", "failed", now - timedelta(hours=24), None, 1, 1, "h"),
    ]
    df = spark.createDataFrame(rows, schemas.TASK_RUNS)
    got = {r.dag_id: r for r in monitoring.failure_audit(df, now).collect()}
    assert set(got) == {"d1", "d3"}
    assert (got["d1"].task_ids, got["d1"].failure_count) == ("t0, t1", failures)
    assert (got["d1"].first_failure, got["d1"].last_failure) == (rows[failures - 1][3], now)
    assert got["d1"].is_worst and not got["d3"].is_worst
    assert {r.escalate for r in got.values()} == {escalates}
    assert monitoring.recent_failures(df, now, n=2).count() == 2


def test_consumer_lag(spark):
    df = spark.createDataFrame(
        [
            ("g", "zero", 0, 10, 10),
            ("g", "at", 0, 0, 2500),
            ("g", "at", 1, 0, 2500),
            ("g", "over", 0, 0, 5001),
            ("g", "never", 0, None, 5),
        ],
        schemas.OFFSETS,
    )
    groups = spark.createDataFrame(
        [("g", t) for t in ("zero", "at", "over", "never", "absent")],
        "consumer_group STRING, topic STRING",
    )
    got = {r.topic: (r.lag, r.level, r.status) for r in monitoring.consumer_lag(df, groups=groups).collect()}
    assert got == {
        "zero": (0, "ok", "ok"),
        "at": (5000, "ok", "ok"),
        "over": (5001, "high", "degraded"),
        "never": (-1, "unreachable", "degraded"),
        "absent": (-1, "unreachable", "degraded"),
    }


def test_component_health(spark):
    df = spark.createDataFrame(
        [
            ("c", T0, True, 1),
            ("c", T0, True, 0),
            ("c", T0, False, 5),
            ("c", T0, None, None),
            ("c", T0 + timedelta(days=1), True, 2),
        ],
        schemas.HEALTH_READINGS,
    )
    got = as_set(
        monitoring.component_uptime(df),
        "check_date",
        "readings",
        "ok_readings",
        "unreachable_readings",
        "uptime_pct",
    )
    assert got == {(date(2024, 1, 1), 4, 1, 2, 25.0), (date(2024, 1, 2), 1, 1, 0, 100.0)}
    states = [r.status for r in monitoring.health_record(df).collect()]
    assert states == ["ok", "degraded", "degraded", "degraded", "ok"]


# -- lifecycle ----------------------------------------------------------------


def test_inactive_users(spark):
    now = at("2024-07-01")
    old = now - timedelta(days=300)
    users = user_rows(
        spark,
        [
            ("edge", "", old, None),
            ("idle", "", old, None),
            ("idle2", "", old, None),
            ("young", "", now - timedelta(days=10), None),
            ("deleted", "", old, old + timedelta(days=1)),
        ],
    )
    df = events(
        spark,
        [
            (1, "edge", "view", now - timedelta(days=180)),
            (2, "idle", "view", now - timedelta(days=180, microseconds=1)),
            (3, None, "view", now),
            (4, "idle2", "view", now + timedelta(days=1)),
        ],
    )
    idle = lifecycle.inactive_users(users, df, now)
    assert {r.user_id for r in idle.collect()} == {"idle", "idle2"}
    assert [r.user_id for r in lifecycle.inactive_users(users, df, now, limit=1).collect()] == ["idle"]
    after = tables.soft_delete(users, idle, F.lit(now.isoformat()).cast("timestamp"))
    marks = {r.user_id: r.deleted_at for r in after.collect()}
    assert marks["idle"] == now and marks["idle2"] == now
    assert marks["edge"] is None and marks["deleted"] == old + timedelta(days=1)
    assert lifecycle.inactive_users(after, df, now).isEmpty()


def test_soft_delete_adds_the_column(spark):
    users = spark.createDataFrame([("a", "x")], "user_id STRING, email STRING")
    ids = spark.createDataFrame([("a",), ("a",)], "user_id STRING")
    got = tables.soft_delete(users, ids, F.lit("2024-01-01").cast("timestamp")).collect()
    assert [(r.user_id, r.deleted_at) for r in got] == [("a", datetime(2024, 1, 1))]


def test_retention(spark):
    now = at("2024-07-01")
    df = live(
        spark,
        [(T0, "a", 1, now - timedelta(days=90)), (T0, "b", 1, now - timedelta(days=90, seconds=1))],
    )
    assert [r.event_type for r in lifecycle.retain(df, "recorded_at", now).collect()] == ["a"]
    assert tuple(lifecycle.retention_stats(df, "recorded_at", now).first()) == (2, 1, 1)


def test_file_retention_is_in_whole_days(spark):
    now = at("2024-07-01")
    files = spark.createDataFrame(
        [
            ("a", 10, now - timedelta(days=30, hours=23)),
            ("b", 20, now - timedelta(days=31)),
        ],
        "path STRING, size BIGINT, modified_at TIMESTAMP",
    )
    plan = lifecycle.file_retention_plan(files, now)
    assert as_set(plan, "path", "age_days", "expired") == {("a", 30, False), ("b", 31, True)}
    summary = lifecycle.apply_retention(plan)
    assert as_set(summary, "expired", "files", "bytes") == {(False, 1, 10), (True, 1, 20)}


def test_missing_partitions(spark):
    def present(days):
        rows = [(date(2024, 1, d),) for d in days]
        return spark.createDataFrame(rows, "dt DATE")

    gaps = lifecycle.missing_partitions(present([1, 3, 4, 6, 7, 8]), "2024-01-08")
    assert [r.dt.day for r in gaps.collect()] == [2, 5]
    full = lifecycle.missing_partitions(present(range(1, 8)), "2024-01-08")
    assert full.isEmpty()

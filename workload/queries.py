"""The named queries: each pairs a Spark callable with its SQL equivalent.

All inputs are whole tables. Timestamps leave as TIMESTAMP_NTZ, which is what
the tables themselves carry.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.intervals import bucket_end, bucket_start, in_interval, ts
from tidemark.layout import DAILY, HOURLY
from tidemark.operators import (
    bitmaps,
    clustering,
    drift,
    duplicates,
    lifecycle,
    messages,
    monitoring,
    payloads,
    quality,
    reports,
    tenants,
)
from tidemark.session import scratch_dir, use_utc
from tidemark.sinks import exports, tables
from tidemark.plans import batch, checks, incremental
from tidemark.plans.lake import Lake
from tidemark.sources.files import (
    list_files,
    partition_dates,
    read_footer_schema,
    read_manifest,
    schema_rows,
)
from tidemark.sources.landing import read_landing, read_tenant_gold
from tidemark.sources.messages import dlq_bounds, read_dlq, read_event_stream
from tidemark.sources.offsets import plan_offsets
from tidemark.streaming import health
from tidemark.streaming.late import write_stream_counts
from tidemark.streaming.metrics import decode_events, first_copies, minute_counts
from tidemark.streaming.sinks import write_stream_split, write_stream_upsert
from workload import inputs, sql

START, END = "2024-01-01", "2024-01-31"
MONTH = (START, END)
AS_OF = "2024-01-31"
WHOLE = f"created_at >= TIMESTAMP '{START}' AND created_at < TIMESTAMP '{END}'"
STREAM_TYPES = ("signup", "click", "view", "purchase")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a callable and its SQL; the result's times become TIMESTAMP_NTZ."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return without_zone(build(spark, sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def without_zone(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# -- extraction and validation ------------------------------------------------


@query(
    "product_conversions",
    f"""WITH {sql.raw()}
    SELECT product_id, COUNT(*) AS total_conversions FROM raw
    WHERE {WHOLE} AND event_type = 'purchase' GROUP BY 1""",
)
def product_conversions(spark, sf_dir):
    return reports.product_conversions(inputs.raw_events(spark, sf_dir), MONTH)


@query(
    "interval_extract",
    f"""WITH {sql.raw()}
    SELECT id, user_id, event_type, payload, product_id, CAST(amount AS DOUBLE) AS amount, created_at
    FROM raw WHERE {WHOLE}""",
)
def interval_extract(spark, sf_dir):
    raw = inputs.raw_events(spark, sf_dir).drop("product_id", "amount")
    events = schemas.normalise(raw.filter(in_interval("created_at", MONTH)))
    return events.withColumn("amount", F.col("amount").cast("double"))


@query(
    "no_null_rows",
    f"""WITH {sql.raw(null_users=True)}
    SELECT id, user_id, event_type, payload, created_at FROM raw
    WHERE user_id IS NOT NULL AND payload IS NOT NULL""",
)
def no_null_rows(spark, sf_dir):
    events = inputs.raw_events(spark, sf_dir, null_users=True)
    clean, _ = quality.drop_nulls(events, ["user_id", "payload"])
    return clean.select("id", "user_id", "event_type", "payload", "created_at")


@query(
    "valid_event_types",
    f"""WITH {sql.raw()}
    SELECT id, user_id, event_type, created_at FROM raw
    WHERE event_type IN ('signup', 'click', 'view', 'purchase')""",
)
def valid_event_types(spark, sf_dir):
    events = inputs.raw_events(spark, sf_dir)
    return quality.keep_allowed(events, "event_type", list(STREAM_TYPES)).select(
        "id", "user_id", "event_type", "created_at"
    )


NULL_RATE_SQL = f"""WITH {sql.raw(null_users=True)},
    rates AS (
        SELECT s.window_start, s.window_start + INTERVAL 1 HOUR AS window_end,
               COUNT(r.id) AS total_rows,
               COUNT(r.id) FILTER (WHERE r.user_id IS NULL OR r.payload IS NULL) AS null_rows
        FROM {sql.hour_spine(START, END)} s
        LEFT JOIN raw r ON date_trunc('hour', r.created_at) = s.window_start
        GROUP BY 1),
    gate AS (
        SELECT *, COALESCE({sql.pct("null_rows", "total_rows")}, 0.0) AS null_pct,
               total_rows > 0 AND null_rows * 100.0 >= total_rows * 5.0 AS quarantine
        FROM rates)"""


@query("null_rate_by_hour", f"{NULL_RATE_SQL} SELECT * FROM gate")
def null_rate_by_hour(spark, sf_dir):
    return quality.null_rate(inputs.raw_events(spark, sf_dir, null_users=True), iv=MONTH)


@query(
    "null_quarantine",
    f"""{NULL_RATE_SQL}
    SELECT r.id AS event_id, g.window_start, g.window_end, 'null_user_id_or_payload' AS reason
    FROM raw r JOIN gate g ON date_trunc('hour', r.created_at) = g.window_start
    WHERE g.quarantine AND (r.user_id IS NULL OR r.payload IS NULL)""",
)
def null_quarantine(spark, sf_dir):
    return quality.null_quarantine(inputs.raw_events(spark, sf_dir, null_users=True), iv=MONTH)


@query(
    "row_count_sla",
    f"""SELECT s.window_start, COUNT(e.event_id) AS row_count, COUNT(e.event_id) >= 10 AS sla_passed
    FROM {sql.hour_spine(START, END)} s
    LEFT JOIN events e ON date_trunc('hour', e.ts) = s.window_start GROUP BY 1""",
)
def row_count_sla(spark, sf_dir):
    return quality.row_count_sla(inputs.raw_events(spark, sf_dir), MONTH)


# -- distributions and schema -------------------------------------------------


@query(
    "type_distribution",
    f"""SELECT event_type, COUNT(*) AS cnt, {sql.pct("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS pct
    FROM events WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}' GROUP BY 1""",
)
def type_distribution(spark, sf_dir):
    return drift.type_distribution(inputs.raw_events(spark, sf_dir), MONTH)


DRIFT_SQL = f"""WITH today AS (
        SELECT event_type, COUNT(*) AS n FROM events
        WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16' GROUP BY 1),
    base AS (
        SELECT event_type, COUNT(*) AS n FROM events
        WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' GROUP BY 1),
    t AS (SELECT event_type, n, {sql.pct("n", "SUM(n) OVER ()")} AS pct FROM today),
    b AS (SELECT event_type, n, {sql.pct("n", "SUM(n) OVER ()")} AS pct FROM base),
    drift AS (
        SELECT COALESCE(t.event_type, b.event_type) AS event_type,
               COALESCE(t.n, 0) AS today_count, COALESCE(b.n, 0) AS baseline_count,
               COALESCE(t.pct, 0.0) AS today_pct, COALESCE(b.pct, 0.0) AS baseline_pct,
               CAST(ABS(CAST(ROUND(COALESCE(t.pct, 0) * 100) AS BIGINT)
                        - CAST(ROUND(COALESCE(b.pct, 0) * 100) AS BIGINT)) AS DOUBLE) / 100
                   AS deviation
        FROM t FULL JOIN b ON t.event_type = b.event_type)"""


@query("distribution_drift", f"{DRIFT_SQL} SELECT * FROM drift")
def distribution_drift(spark, sf_dir):
    return drift.distribution_drift(inputs.raw_events(spark, sf_dir), "2024-01-15")


@query(
    "stored_distribution_drift",
    f"{DRIFT_SQL} SELECT event_type, today_pct, baseline_pct, deviation FROM drift",
)
def stored_distribution_drift(spark, sf_dir):
    events = inputs.raw_events(spark, sf_dir)
    today = drift.type_distribution(events, ("2024-01-15", "2024-01-16"))
    baseline = drift.type_distribution(events, ("2024-01-08", "2024-01-15"))
    return drift.compare_distributions(today, baseline)


def _audit_sql(threshold: float) -> str:
    def shares(value: str, count: str) -> str:
        entry = f"""'"' || event_type || '":' || CAST({value} AS VARCHAR)"""
        listed = f"string_agg({entry}, ',' ORDER BY event_type) FILTER (WHERE {count} > 0)"
        return f"'{{' || {listed} || '}}'"

    return f"""{DRIFT_SQL}
    SELECT DATE '2024-01-15' AS report_date, MAX(deviation) >= {threshold} AS drift_detected,
           MAX(deviation) AS max_deviation_pct,
           {shares("today_pct", "today_count")} AS today_dist,
           {shares("baseline_pct", "baseline_count")} AS baseline_dist
    FROM drift"""


@query("distribution_audit", _audit_sql(10.0))
def distribution_audit(spark, sf_dir):
    changes = drift.distribution_drift(inputs.raw_events(spark, sf_dir), "2024-01-15")
    return drift.drift_audit(changes, "2024-01-15")


@query("distribution_audit_tight", _audit_sql(2.0))
def distribution_audit_tight(spark, sf_dir):
    changes = drift.distribution_drift(inputs.raw_events(spark, sf_dir), "2024-01-15")
    return drift.drift_audit(changes, "2024-01-15", threshold=2.0)


@query(
    "schema_drift_report",
    """WITH expected AS (
        SELECT * FROM (VALUES ('id', 'bigint'), ('user_id', 'string'), ('event_type', 'string'),
                              ('payload', 'string'), ('created_at', 'timestamp'))
        t(col_name, expected_type)),
    actual AS (
        SELECT column_name AS col_name,
               CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                                ELSE lower(column_type) END AS actual_type
        FROM (DESCRIBE events)),
    both_sides AS (
        SELECT COALESCE(e.col_name, a.col_name) AS col_name,
               CASE WHEN a.col_name IS NULL THEN 'missing' WHEN e.col_name IS NULL THEN 'extra'
                    WHEN expected_type <> actual_type THEN 'type_mismatch' END AS status,
               expected_type, actual_type
        FROM expected e FULL JOIN actual a ON e.col_name = a.col_name)
    SELECT * FROM both_sides WHERE status IS NOT NULL""",
)
def schema_drift_report(spark, sf_dir):
    actual = schema_rows(read_footer_schema(spark, f"{sf_dir}/events.parquet"))
    reference = spark.createDataFrame(
        list(drift.REFERENCE_SCHEMA.items()), "col_name STRING, data_type STRING"
    )
    return drift.schema_drift(actual, reference)


@query(
    "payload_key_drift",
    f"""WITH {sql.raw()},
    keys AS (SELECT date_trunc('day', created_at) AS window_start, id,
                    unnest(json_keys(payload)) AS key FROM raw),
    days AS (SELECT date_trunc('day', created_at) AS window_start, COUNT(*) AS total_rows
             FROM raw GROUP BY 1),
    counted AS (SELECT window_start, key, COUNT(*) AS n FROM keys GROUP BY ALL),
    wanted AS (SELECT window_start, unnest(['product_id', 'currency']) AS key FROM days),
    pairs AS (SELECT window_start, key FROM wanted UNION SELECT window_start, key FROM counted)
    SELECT p.window_start, p.key, COALESCE(c.n, 0) AS present_rows, d.total_rows,
           {sql.pct("COALESCE(c.n, 0)", "d.total_rows")} AS presence_pct,
           CASE WHEN p.key NOT IN ('product_id', 'currency') THEN 'extra'
                WHEN COALESCE(c.n, 0) = 0 THEN 'missing'
                WHEN c.n < d.total_rows THEN 'partial' ELSE 'ok' END AS status
    FROM pairs p JOIN days d USING (window_start) LEFT JOIN counted c USING (window_start, key)""",
)
def payload_key_drift(spark, sf_dir):
    return drift.payload_key_drift(inputs.raw_events(spark, sf_dir), ("product_id", "currency"))


@query(
    "payload_path_drift",
    f"""WITH {sql.raw()}, r AS (
        SELECT date_trunc('day', created_at) AS window_start, id, id % 101 <> 0 AS ok FROM raw
    ), drift AS (
        SELECT window_start, '$' AS path, 'OBJECT' AS expected_type, 'INVALID' AS actual_type,
            'type_mismatch' AS status FROM r WHERE NOT ok
        UNION ALL SELECT window_start, '$.product_id', 'BIGINT', 'STRING', 'type_mismatch' FROM r
            WHERE ok AND id % 41 = 0
        UNION ALL SELECT window_start, '$.context.device.version', 'BIGINT', 'STRING', 'type_mismatch'
            FROM r WHERE ok AND id % 7 = 0
        UNION ALL SELECT window_start, '$.context.device.os', 'STRING', 'VOID', 'null' FROM r
            WHERE ok AND id % 13 = 0
        UNION ALL SELECT window_start, '$.context.tags', 'ARRAY<BIGINT>', 'ARRAY<VARIANT>', 'type_mismatch'
            FROM r WHERE ok AND id % 9 = 0
        UNION ALL SELECT window_start, '$.debug', NULL, 'BOOLEAN', 'extra' FROM r WHERE ok AND id % 97 = 0
        UNION ALL SELECT window_start, '$.amount', 'DECIMAL', NULL, 'missing' FROM r
            WHERE NOT ok OR id % 53 = 0
        UNION ALL SELECT window_start, '$.currency', 'STRING', NULL, 'missing' FROM r
        UNION ALL SELECT window_start, p, t, NULL, 'missing' FROM r, (VALUES ('$.product_id', 'BIGINT'),
            ('$.context', 'OBJECT'), ('$.context.device', 'OBJECT'), ('$.context.device.os', 'STRING'),
            ('$.context.device.version', 'BIGINT'), ('$.context.tags', 'ARRAY<BIGINT>')) v(p, t) WHERE NOT ok
    )
    SELECT window_start, path, expected_type, actual_type, COUNT(*) AS "rows", status
    FROM drift GROUP BY ALL""",
)
def payload_path_drift(spark, sf_dir):
    """Nested payloads, damaged by id, against the types that are expected of their paths."""
    every = lambda n: F.pmod(F.col("id"), F.lit(n)) == 0
    text = F.concat(
        F.lit('{"product_id": '),
        F.when(every(41), F.lit('"7"')).otherwise(F.col("product_id").cast("string")),
        F.when(every(53), F.lit("")).otherwise(
            F.concat(F.lit(', "amount": '), F.col("amount").cast("decimal(12,2)").cast("string"))
        ),
        F.lit(', "context": {"device": {"os": '),
        F.when(every(13), F.lit("null")).otherwise(F.lit('"x"')),
        F.lit(', "version": '),
        F.when(every(7), F.lit('"2"')).otherwise(F.lit("2")),
        F.lit('}, "tags": [1, '),
        F.when(every(9), F.lit('"a"')).otherwise(F.lit("3")),
        F.lit("]}"),
        F.when(every(97), F.lit(', "debug": true')).otherwise(F.lit("")),
        F.when(every(101), F.lit("")).otherwise(F.lit("}")),
    )
    events = inputs.raw_events(spark, sf_dir).withColumn("payload", text)
    expected = {
        "$.product_id": "BIGINT",
        "$.amount": "DECIMAL",
        "$.currency": "STRING",
        "$.context.device.os": "STRING",
        "$.context.device.version": "BIGINT",
        "$.context.tags": "ARRAY<BIGINT>",
    }
    return payloads.payload_path_drift(payloads.payload_types(events), expected)


# -- duplicates ---------------------------------------------------------------

RANK_SQL = f"""WITH {sql.raw(null_users=True, copies=True)},
    ranked AS (
        SELECT *, ROW_NUMBER() OVER (
                   PARTITION BY user_id, event_type, date_trunc('second', created_at)
                   ORDER BY id) AS rn
        FROM raw)"""


def _with_copies(spark, sf_dir):
    return inputs.raw_events(spark, sf_dir, null_users=True, copies=True)


@query(
    "duplicate_rank",
    f"""{RANK_SQL} SELECT id AS event_id, date_trunc('hour', created_at) AS window_start, rn
    FROM ranked""",
)
def duplicate_rank(spark, sf_dir):
    return duplicates.duplicate_rank(_with_copies(spark, sf_dir))


@query(
    "duplicate_audit",
    f"""{RANK_SQL} SELECT id AS event_id, date_trunc('hour', created_at) AS window_start, rn
    FROM ranked WHERE rn > 1""",
)
def duplicate_audit(spark, sf_dir):
    return duplicates.duplicate_audit(_with_copies(spark, sf_dir))


@query(
    "duplicate_counts",
    f"""{RANK_SQL} SELECT date_trunc('hour', created_at) AS window_start, COUNT(*) AS total_rows,
        COUNT(*) FILTER (WHERE rn > 1) AS duplicate_count FROM ranked GROUP BY 1""",
)
def duplicate_counts(spark, sf_dir):
    return duplicates.duplicate_counts(_with_copies(spark, sf_dir))


@query(
    "deduplicated_events",
    f"{RANK_SQL} SELECT id, user_id, event_type, payload, created_at FROM ranked WHERE rn = 1",
)
def deduplicated_events(spark, sf_dir):
    return duplicates.deduplicate(_with_copies(spark, sf_dir)).select(
        "id", "user_id", "event_type", "payload", "created_at"
    )


# -- reports ------------------------------------------------------------------


@query(
    "daily_event_summary",
    f"""WITH h AS (
        SELECT CAST(ts AS DATE) AS report_date, CAST(extract(hour FROM ts) AS INTEGER) AS event_hour,
               event_type, COUNT(*) AS event_count
        FROM events WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}' GROUP BY ALL)
    SELECT *, {sql.pct("event_count", "SUM(event_count) OVER (PARTITION BY report_date)")}
        AS pct_of_daily FROM h""",
)
def daily_event_summary(spark, sf_dir):
    return reports.daily_event_summary(inputs.raw_events(spark, sf_dir), MONTH)


@query("minute_counts", f"WITH {sql.MINUTES} SELECT * FROM minutes")
def minute_counts_query(spark, sf_dir):
    return minute_counts(inputs.raw_events(spark, sf_dir), time_col="created_at")


HOURLY_SQL = f"""WITH {sql.MINUTES},
    h AS (SELECT date_trunc('hour', window_start) AS hour_start, event_type,
                 CAST(SUM(event_count) AS BIGINT) AS total_count
          FROM minutes GROUP BY ALL)
    SELECT *, CAST((total_count * 200 + 60) // 120 AS DOUBLE) / 100 AS avg_per_minute FROM h"""


@query("hourly_rollup", HOURLY_SQL)
def hourly_rollup(spark, sf_dir):
    emitted = inputs.minute_metrics(spark, sf_dir)
    # An append-only sink sees earlier, partial counts of the same windows.
    partial = emitted.withColumns(
        {
            "event_count": F.floor(F.col("event_count") / 2).cast("bigint"),
            "recorded_at": F.col("window_start"),
        }
    )
    return reports.hourly_rollup(emitted.unionByName(partial), MONTH)


COHORT_SQL = f"""{sql.USERS},
    cohorts AS (SELECT user_id, CAST(date_trunc('week', created_at) AS DATE) AS cohort_week
                FROM users
                WHERE deleted_at IS NULL OR deleted_at > TIMESTAMP '2024-01-15')"""


@query("user_cohorts", f"WITH {COHORT_SQL} SELECT * FROM cohorts")
def user_cohorts(spark, sf_dir):
    return reports.user_cohorts(inputs.users(spark, sf_dir), "2024-01-15")


WEEKLY_SQL = f"""WITH {sql.raw()}, {COHORT_SQL}
    SELECT c.cohort_week, DATE '2024-01-15' AS report_week, COUNT(r.id) AS event_count,
           COUNT(DISTINCT r.user_id) AS unique_users
    FROM raw r JOIN users u ON u.user_id = r.user_id JOIN cohorts c ON c.user_id = u.user_id
    WHERE r.created_at >= TIMESTAMP '2024-01-08' AND r.created_at < TIMESTAMP '2024-01-15'
    GROUP BY 1"""


@query("weekly_cohort_metrics", WEEKLY_SQL)
def weekly_cohort_metrics(spark, sf_dir):
    users = inputs.users(spark, sf_dir)
    cohorts = reports.user_cohorts(users, "2024-01-15")
    return reports.weekly_cohort_metrics(
        inputs.raw_events(spark, sf_dir), users, cohorts, "2024-01-15"
    )


@query(
    "cohort_users_from_bitmaps",
    f"""WITH {sql.raw()}, {COHORT_SQL},
    ends AS (SELECT CAST(unnest(generate_series(DATE '2024-01-08', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE)
                 AS period_end)
    SELECT period_end, c.cohort_week, COUNT(r.id) AS event_count, COUNT(DISTINCT r.user_id) AS unique_users
    FROM ends JOIN raw r ON r.created_at >= period_end - INTERVAL 7 DAY AND r.created_at < period_end
    JOIN cohorts c ON c.user_id = r.user_id
    GROUP BY 1, 2""",
)
def cohort_users_from_bitmaps(spark, sf_dir):
    """Twenty-four overlapping weeks as unions of stored days. Half of the users get their
    numbers in a second run, after the first half's days are stored."""
    root = scratch_dir(spark, "bitmaps")
    events = inputs.raw_events(spark, sf_dir)
    cohorts = reports.user_cohorts(inputs.users(spark, sf_dir), "2024-01-15")
    early = cohorts.filter(F.pmod(F.xxhash64("user_id"), F.lit(2)) == 0)
    for users in (early, cohorts):
        known = tables.read_or_empty(spark, f"{root}/numbers", schemas.USER_NUMBERS)
        tables.append_log(bitmaps.new_user_numbers(known, users), f"{root}/numbers")
        numbers = spark.read.parquet(f"{root}/numbers")
        days = bitmaps.daily_user_bitmaps(events, users, numbers, MONTH)
        tables.replace_interval(days, f"{root}/days", DAILY, MONTH, "report_date")
    ends = [f"2024-01-{d:02d}" for d in range(8, 32)]
    return bitmaps.users_of_periods(spark.read.parquet(f"{root}/days"), ends)


@query(
    "monthly_kpis",
    f"""WITH {sql.raw(null_users=True, messy_amounts=True)},
    priced AS (SELECT *, json_extract_string(payload, '$.amount') AS t FROM raw
               WHERE event_type = 'purchase'),
    k AS (SELECT COUNT(*) AS n, COUNT(DISTINCT user_id) AS buyers,
                 SUM(CASE WHEN regexp_full_match(t, '[0-9.]+')
                          THEN TRY_CAST(t AS DECIMAL(12,2)) END) AS total,
                 COUNT(CASE WHEN regexp_full_match(t, '[0-9.]+')
                            THEN TRY_CAST(t AS DECIMAL(12,2)) END) AS priced
          FROM priced
          WHERE created_at >= TIMESTAMP '2024-01-01' AND created_at < TIMESTAMP '2024-02-01'),
    m AS (SELECT n, buyers, CAST((CAST(total * 100 AS BIGINT) * 2 + priced)
                                 // (2 * priced) AS DOUBLE) / 100 AS mean FROM k)
    SELECT '2023-12' AS report_month, CAST(0 AS BIGINT) AS total_purchases,
           CAST(0 AS BIGINT) AS unique_buyers, CAST(0 AS DOUBLE) AS avg_amount,
           true AS is_zero_warning, CAST(NULL AS BIGINT) AS purchases_change,
           CAST(NULL AS DOUBLE) AS avg_amount_change
    UNION ALL SELECT '2024-01', n, buyers, mean, false, n, mean FROM m
    UNION ALL SELECT '2024-02', 0, 0, 0, true, -n, -mean FROM m""",
)
def monthly_kpis(spark, sf_dir):
    events = inputs.raw_events(spark, sf_dir, null_users=True, messy_amounts=True)
    return reports.monthly_kpis(events, ["2023-12", "2024-01", "2024-02"])


@query(
    "error_summary",
    f"""WITH e AS (
        SELECT to_timestamp(CAST(epoch(date_trunc('second', ts)) AS BIGINT) // 7200 * 7200)
                   AT TIME ZONE 'UTC' AS window_start,
               CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 4
                   WHEN 0 THEN 'schema_error' WHEN 1 THEN 'timeout'
                   WHEN 2 THEN 'rate_limit' ELSE 'auth_error' END AS error_type
        FROM events WHERE event_type = 'error'),
    c AS (SELECT window_start, error_type, COUNT(*) AS error_count FROM e GROUP BY ALL)
    SELECT *, {sql.pct("error_count", "SUM(error_count) OVER w")} AS pct_of_total,
           MAX(error_type = 'auth_error') OVER w OR SUM(error_count) OVER w > 1000 AS is_critical
    FROM c WINDOW w AS (PARTITION BY window_start)""",
)
def error_summary(spark, sf_dir):
    return reports.error_summary(inputs.ingestion_errors(spark, sf_dir))


# -- users and retention ------------------------------------------------------

INACTIVE_SQL = f"""WITH {sql.raw()}, {sql.USERS},
    inactive AS (
        SELECT u.user_id, u.email, u.created_at FROM users u
        LEFT JOIN (SELECT DISTINCT user_id FROM raw
                   WHERE created_at >= TIMESTAMP '2024-01-31' - INTERVAL 180 DAY
                     AND created_at <= TIMESTAMP '2024-01-31') r ON r.user_id = u.user_id
        WHERE r.user_id IS NULL
          AND (u.deleted_at IS NULL OR u.deleted_at > TIMESTAMP '2024-01-31')
          AND u.created_at < TIMESTAMP '2024-01-31' - INTERVAL 180 DAY)"""


def _inactive(spark, sf_dir):
    return lifecycle.inactive_users(
        inputs.users(spark, sf_dir), inputs.raw_events(spark, sf_dir), AS_OF
    )


@query("inactive_users", f"{INACTIVE_SQL} SELECT * FROM inactive")
def inactive_users(spark, sf_dir):
    return _inactive(spark, sf_dir)


@query(
    "users_after_soft_delete",
    f"""{INACTIVE_SQL}
    SELECT u.user_id, u.email, u.created_at,
           COALESCE(u.deleted_at, CASE WHEN i.user_id IS NOT NULL THEN TIMESTAMP '2024-01-31' END)
               AS deleted_at
    FROM users u LEFT JOIN inactive i ON i.user_id = u.user_id""",
)
def users_after_soft_delete(spark, sf_dir):
    return tables.soft_delete(inputs.users(spark, sf_dir), _inactive(spark, sf_dir), ts(AS_OF))


@query(
    "archived_users",
    f"""{INACTIVE_SQL}
    SELECT *, TIMESTAMP '2024-01-31' AS archived_at, 'inactive_180d' AS archive_reason,
           DATE '2024-01-31' AS archive_date FROM inactive""",
)
def archived_users(spark, sf_dir):
    """A run with a limit, one over the others, and a repeated one: the archive holds them all."""
    path = scratch_dir(spark, "archived-users")
    idle = _inactive(spark, sf_dir)
    for run in (idle.orderBy("user_id").limit(2), idle, idle):
        exports.archive(run, path, AS_OF, "inactive_180d")
    return spark.read.parquet(path)


@query(
    "inactive_users_limited",
    f"{INACTIVE_SQL} SELECT * FROM inactive ORDER BY user_id LIMIT 100",
)
def inactive_users_limited(spark, sf_dir):
    return lifecycle.inactive_users(
        inputs.users(spark, sf_dir), inputs.raw_events(spark, sf_dir), AS_OF, limit=100
    )


@query(
    "retention_survivors",
    f"""WITH {sql.MINUTES} SELECT *, window_end AS recorded_at FROM minutes
    WHERE window_end >= TIMESTAMP '2024-01-31' - INTERVAL 10 DAY""",
)
def retention_survivors(spark, sf_dir):
    return lifecycle.retain(inputs.minute_metrics(spark, sf_dir), "recorded_at", AS_OF, days=10)


@query(
    "retention_stats",
    f"""WITH {sql.MINUTES}
    SELECT COUNT(*) AS rows_before,
           COUNT(*) FILTER (WHERE window_end < TIMESTAMP '2024-01-31' - INTERVAL 10 DAY)
               AS rows_deleted,
           COUNT(*) FILTER (WHERE window_end >= TIMESTAMP '2024-01-31' - INTERVAL 10 DAY)
               AS rows_after
    FROM minutes""",
)
def retention_stats(spark, sf_dir):
    metrics = inputs.minute_metrics(spark, sf_dir)
    return lifecycle.retention_stats(metrics, "recorded_at", AS_OF, days=10)


# -- monitoring ---------------------------------------------------------------


def _freshness_sql(as_of: str) -> str:
    return f"""WITH {sql.MINUTES},
    s AS (SELECT event_type, MAX(ts) AS newest FROM events GROUP BY 1),
    g AS (SELECT event_type, MAX(window_end) AS newest FROM minutes GROUP BY 1),
    l AS (SELECT event_type,
                 CAST(trunc(epoch_us(TIMESTAMP '{as_of}' - s.newest) / 1000000.0) AS BIGINT)
                     AS source_lag_seconds,
                 CAST(trunc(epoch_us(TIMESTAMP '{as_of}' - g.newest) / 1000000.0) AS BIGINT)
                     AS gold_lag_seconds
          FROM s JOIN g USING (event_type))
    SELECT *, GREATEST(source_lag_seconds, gold_lag_seconds) AS e2e_lag_seconds,
           GREATEST(source_lag_seconds, gold_lag_seconds) <= 7200 AS sla_met,
           CAST(7200 AS BIGINT) AS sla_target_seconds FROM l"""


def _freshness(spark, sf_dir, as_of):
    gold = inputs.minute_metrics(spark, sf_dir).withColumn("modified_at", F.col("window_end"))
    return monitoring.freshness(
        inputs.raw_events(spark, sf_dir), gold, as_of, by=("event_type",)
    )


@query("freshness_sla", _freshness_sql("2024-01-31 00:00:00"))
def freshness_sla(spark, sf_dir):
    return _freshness(spark, sf_dir, "2024-01-31 00:00:00")


@query("freshness_sla_later", _freshness_sql("2024-01-31 03:00:00"))
def freshness_sla_later(spark, sf_dir):
    return _freshness(spark, sf_dir, "2024-01-31 03:00:00")


@query(
    "freshness_compliance",
    f"""WITH log AS (
        SELECT event_type, date_trunc('hour', ts) AS h,
               epoch_us(date_trunc('hour', MAX(ts)) + INTERVAL 1 HOUR - MAX(ts)) <= 600000000
                   AS sla_met
        FROM events GROUP BY 1, 2)
    SELECT event_type, COUNT(*) AS measurements, COUNT(*) FILTER (WHERE sla_met) AS met,
           {sql.pct("COUNT(*) FILTER (WHERE sla_met)", "COUNT(*)")} AS compliance_pct
    FROM log GROUP BY 1""",
)
def freshness_compliance(spark, sf_dir):
    """Log of hourly measurements: is the last event of the hour at most 600 s old at its end?"""
    hour = bucket_start("created_at", "1 hour")
    log = (
        inputs.raw_events(spark, sf_dir)
        .groupBy("event_type", hour.alias("_hour"))
        .agg(F.max("created_at").alias("_newest"))
        .select(
            "event_type",
            (
                F.unix_micros(bucket_end("_hour", "1 hour")) - F.unix_micros("_newest")
                <= 600_000_000
            ).alias("sla_met"),
        )
    )
    return monitoring.freshness_compliance(log, by=("event_type",))


@query(
    "stream_health",
    f"""WITH {sql.MINUTES}
    SELECT event_type,
           epoch_us(TIMESTAMP '2024-01-31' - MAX(window_end)) / 3600000000.0 AS lag_hours,
           epoch_us(TIMESTAMP '2024-01-31' - MAX(window_end)) / 3600000000.0 <= 2 AS healthy
    FROM minutes GROUP BY 1""",
)
def stream_health(spark, sf_dir):
    return monitoring.stream_health(
        inputs.minute_metrics(spark, sf_dir), AS_OF, by=("event_type",)
    )


@query(
    "adaptive_mode",
    f"""WITH slots AS (
        SELECT 't' || CAST(t AS VARCHAR) AS pipeline, window_start
        FROM {sql.hour_spine(START, END)} s, (VALUES (0), (1), (2)) v(t)),
    counts AS (
        SELECT 't' || CAST(user_id % 3 AS VARCHAR) AS pipeline, date_trunc('hour', ts) AS window_start,
               COUNT(*) AS n FROM events GROUP BY ALL),
    log AS (SELECT s.pipeline, CAST(s.window_start AS DATE) AS run_date, s.window_start,
                   COALESCE(c.n, 0) AS row_count
            FROM slots s LEFT JOIN counts c USING (pipeline, window_start)),
    last AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY pipeline, run_date
                                          ORDER BY window_start DESC) AS rn FROM log)
    SELECT pipeline, run_date, COUNT(*) AS runs_seen, COUNT(*) = 3 AND BOOL_AND(row_count < 5)
               AS needs_full_reprocess,
           CASE WHEN COUNT(*) = 3 AND BOOL_AND(row_count < 5) THEN 'full' ELSE 'incremental' END
               AS mode,
           CASE WHEN COUNT(*) = 3 AND BOOL_AND(row_count < 5) THEN TIMESTAMP '2024-01-30'
                ELSE TIMESTAMP '2024-01-31 05:00:00' END AS start,
           CASE WHEN COUNT(*) = 3 AND BOOL_AND(row_count < 5) THEN TIMESTAMP '2024-01-31'
                ELSE TIMESTAMP '2024-01-31 06:00:00' END AS "end"
    FROM last WHERE rn <= 3 GROUP BY 1, 2""",
)
def adaptive_mode(spark, sf_dir):
    log = inputs.run_log(spark, sf_dir, MONTH)
    decisions = monitoring.adaptive_mode(log, n=3, min_rows=5, by=("pipeline", "run_date"))
    return monitoring.adaptive_interval(
        decisions, ("2024-01-31 05:00:00", "2024-01-31 06:00:00")
    )


TASKS_SQL = f"""WITH {sql.TASKS},
    f AS (SELECT * FROM tasks WHERE state = 'failed'
          AND start_date >= TIMESTAMP '2001-08-02' - INTERVAL 192 HOUR
          AND start_date <= TIMESTAMP '2001-08-02')"""


@query(
    "failure_audit",
    f"""{TASKS_SQL},
    a AS (SELECT dag_id, string_agg(DISTINCT task_id, ', ' ORDER BY task_id) AS task_ids,
                 COUNT(*) AS failure_count, MIN(start_date) AS first_failure,
                 MAX(start_date) AS last_failure
          FROM f GROUP BY 1)
    SELECT DATE '2001-08-02' AS report_date, *,
           ROW_NUMBER() OVER (ORDER BY failure_count DESC, last_failure DESC, dag_id) = 1
               AS is_worst,
           MAX(failure_count) OVER () > 5 AS escalate
    FROM a""",
)
def failure_audit(spark, sf_dir):
    return monitoring.failure_audit(inputs.task_runs(spark, sf_dir), "2001-08-02", hours=192)


@query(
    "recent_failures_topk",
    f"""WITH {sql.TASKS}
    SELECT dag_id, task_id, state, start_date, try_number FROM tasks
    WHERE state = 'failed' AND start_date >= TIMESTAMP '2001-08-02' - INTERVAL 10000 HOUR
      AND start_date <= TIMESTAMP '2001-08-02'
    ORDER BY start_date DESC, dag_id, task_id, try_number LIMIT 1000""",
)
def recent_failures_topk(spark, sf_dir):
    runs = inputs.task_runs(spark, sf_dir)
    return monitoring.recent_failures(runs, "2001-08-02", n=1000, hours=10_000)


@query(
    "consumer_lag",
    """WITH o AS (
        SELECT user_id % 4 AS partition, MAX(event_id) FILTER (WHERE event_type = 'purchase') AS c,
               MAX(event_id) AS e FROM events GROUP BY 1),
    l AS (SELECT 'metrics' AS consumer_group, 'topic_' || CAST(partition % 2 AS VARCHAR) AS topic,
                 CAST(SUM(e - c) AS BIGINT) AS lag FROM o GROUP BY 2)
    SELECT consumer_group, topic, COALESCE(lag, -1) AS lag, lag IS NOT NULL AS reachable,
           CASE WHEN lag IS NULL THEN 'unreachable' WHEN lag > 20 THEN 'high' ELSE 'ok' END AS level,
           CASE WHEN lag <= 20 THEN 'ok' ELSE 'degraded' END AS status
    FROM l""",
)
def consumer_lag(spark, sf_dir):
    return monitoring.consumer_lag(inputs.offsets(spark, sf_dir), threshold=20)


@query(
    "component_uptime",
    f"""WITH r AS (
        SELECT event_type AS component, CAST(ts AS DATE) AS check_date,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
    SELECT component, check_date, COUNT(*) AS readings,
           COUNT(*) FILTER (WHERE k % 10 <> 0 AND k % 3 >= 1) AS ok_readings,
           COUNT(*) FILTER (WHERE k % 10 = 0) AS unreachable_readings,
           {sql.pct("COUNT(*) FILTER (WHERE k % 10 <> 0 AND k % 3 >= 1)", "COUNT(*)")} AS uptime_pct
    FROM r GROUP BY 1, 2""",
)
def component_uptime(spark, sf_dir):
    return monitoring.component_uptime(inputs.health_readings(spark, sf_dir))


# -- tenants ------------------------------------------------------------------


@query(
    "tenant_conversions",
    f"""WITH {sql.TENANT_GOLD} SELECT product_id, event_type, total_conversions, tenant_id
    FROM tenant_gold WHERE event_type = 'purchase'""",
)
def tenant_conversions(spark, sf_dir):
    return tenants.tenant_conversions(
        inputs.tenant_events(spark, sf_dir), inputs.manifest(spark), AS_OF
    )


RANKING_SQL = f"""WITH {sql.TENANT_GOLD},
    totals AS (
        SELECT m.tenant_id, m.position, COALESCE(SUM(g.total_conversions), 0)::BIGINT AS event_count,
               COALESCE(SUM(g.total_conversions) FILTER (WHERE g.event_type = 'purchase'), 0)::BIGINT
                   AS purchase_count
        FROM {sql.TENANT_DAYS} m(tenant_id, position, days)
        LEFT JOIN tenant_gold g ON g.tenant_id = m.tenant_id GROUP BY 1, 2),
    ranking AS (
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY event_count DESC, position) AS INTEGER) AS rank,
               tenant_id, event_count, purchase_count,
               COALESCE({sql.pct("purchase_count", "event_count")}, 0.0) AS purchase_rate
        FROM totals)"""


def _all_types_gold(spark, sf_dir):
    return tenants.tenant_conversions(
        inputs.tenant_events(spark, sf_dir),
        inputs.manifest(spark, extra_tenant=True),
        AS_OF,
        event_type=None,
    )


@query("tenant_ranking", f"{RANKING_SQL} SELECT * FROM ranking")
def tenant_ranking(spark, sf_dir):
    return tenants.tenant_ranking(
        _all_types_gold(spark, sf_dir), inputs.manifest(spark, extra_tenant=True)
    )


@query(
    "cross_tenant_comparison",
    f"""{RANKING_SQL}
    SELECT DATE '2024-01-29' AS report_week,
           MAX(tenant_id) FILTER (WHERE rank = 1) AS top_tenant,
           '{{"report_week":"2024-01-29","tenants":[' || string_agg(
               '{{"rank":' || rank || ',"tenant":"' || tenant_id || '","event_count":' || event_count
               || ',"purchase_count":' || purchase_count || ',"purchase_rate":'
               || CAST(purchase_rate AS VARCHAR) || '}}', ',' ORDER BY rank) || ']}}' AS details
    FROM ranking""",
)
def cross_tenant_comparison(spark, sf_dir):
    return tenants.cross_tenant_comparison(
        _all_types_gold(spark, sf_dir), inputs.manifest(spark, extra_tenant=True), "2024-01-29"
    )


@query(
    "batch_tenant_join",
    f"""WITH {sql.raw()}, {sql.TENANT_GOLD},
    b AS (SELECT product_id, COUNT(*) AS n FROM raw
          WHERE created_at >= TIMESTAMP '2024-01-24' AND created_at < TIMESTAMP '2024-01-31'
            AND event_type = 'purchase' GROUP BY 1),
    t AS (SELECT product_id, CAST(SUM(total_conversions) AS BIGINT) AS n FROM tenant_gold
          WHERE event_type = 'purchase' GROUP BY 1)
    SELECT COALESCE(b.product_id, t.product_id) AS product_id,
           COALESCE(b.n, 0) AS batch_conversions, COALESCE(t.n, 0) AS tenant_conversions,
           {sql.pct("COALESCE(t.n, 0)", "COALESCE(b.n, 0)")} AS tenant_share
    FROM b FULL JOIN t ON b.product_id = t.product_id""",
)
def batch_tenant_join(spark, sf_dir):
    batch = reports.product_conversions(
        inputs.raw_events(spark, sf_dir), ("2024-01-24", "2024-01-31")
    )
    tenant = tenants.tenant_conversions(
        inputs.tenant_events(spark, sf_dir), inputs.manifest(spark), AS_OF
    )
    return tenants.batch_tenant_join(batch, tenant)


# -- partitions ---------------------------------------------------------------


def _missing(spark, sf_dir):
    days = inputs.raw_events(spark, sf_dir).select(F.col("created_at").cast("date").alias("dt"))
    lost = [F.lit(d).cast("date") for d in ("2024-01-12", "2024-01-14")]
    return lifecycle.missing_partitions(days.filter(~F.col("dt").isin(lost)), "2024-01-16")


@query(
    "missing_partitions",
    """SELECT CAST(d AS DATE) AS dt
    FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-09', TIMESTAMP '2024-01-15',
                                        INTERVAL 1 DAY)) AS d)
    WHERE CAST(d AS DATE) NOT IN (
        SELECT CAST(ts AS DATE) FROM events
        WHERE CAST(ts AS DATE) NOT IN (DATE '2024-01-12', DATE '2024-01-14'))""",
)
def missing_partitions(spark, sf_dir):
    return _missing(spark, sf_dir)


@query(
    "backfill_conversions",
    f"""WITH {sql.raw()}
    SELECT date_trunc('day', created_at) AS window_start, product_id, COUNT(*) AS total_conversions
    FROM raw WHERE event_type = 'purchase'
      AND CAST(created_at AS DATE) IN (DATE '2024-01-12', DATE '2024-01-14') GROUP BY 1, 2""",
)
def backfill_conversions(spark, sf_dir):
    period = ("2024-01-09", "2024-01-16")
    return lifecycle.backfill(
        inputs.raw_events(spark, sf_dir),
        _missing(spark, sf_dir),
        lambda df: reports.product_conversions(df, period, every="1 day"),
        "2024-01-16",
    )


# -- sinks --------------------------------------------------------------------


def _daily_counts(spark, sf_dir, iv, mode: str, first_seen: str):
    return (
        inputs.raw_events(spark, sf_dir)
        .filter(in_interval("created_at", iv))
        .groupBy(F.col("created_at").cast("date").alias("report_date"), "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .withColumns({"mode": F.lit(mode), "first_seen": F.lit(first_seen)})
    )


@query(
    "upsert_result",
    """WITH d AS (SELECT CAST(ts AS DATE) AS report_date, event_type, COUNT(*) AS event_count
              FROM events GROUP BY ALL)
    SELECT report_date, event_type, event_count,
           CASE WHEN report_date >= DATE '2024-01-15' AND event_type IN ('purchase', 'view')
                THEN 'second' ELSE 'first' END AS mode,
           CASE WHEN report_date >= DATE '2024-01-20' THEN 'run 2' ELSE 'run 1' END AS first_seen
    FROM d WHERE report_date < DATE '2024-01-20'
       OR (event_type IN ('purchase', 'view') AND report_date < DATE '2024-01-31')""",
)
def upsert_result(spark, sf_dir):
    """Two overlapping runs; the second replaces all but the first_seen column."""
    path = scratch_dir(spark, "upsert")
    keys, part = ("report_date", "event_type"), ("report_date",)
    first = _daily_counts(spark, sf_dir, (START, "2024-01-20"), "first", "run 1")
    second = _daily_counts(spark, sf_dir, ("2024-01-15", END), "second", "run 2")
    second = quality.keep_allowed(second, "event_type", ["purchase", "view"])
    tables.upsert_table(first, path, keys, part, keep_cols=("first_seen",))
    for _ in range(2):
        tables.upsert_table(second, path, keys, part, keep_cols=("first_seen",))
    return spark.read.parquet(path).select(*first.columns)


@query(
    "insert_if_absent_result",
    f"""WITH {sql.USERS}
    SELECT user_id, CASE WHEN created_at < TIMESTAMP '1996-01-01'
                         THEN CAST(date_trunc('week', created_at) AS DATE)
                         ELSE CAST(date_trunc('week', created_at) AS DATE) + 7 END AS cohort_week
    FROM users WHERE deleted_at IS NULL OR deleted_at > TIMESTAMP '2024-01-15'""",
)
def insert_if_absent_result(spark, sf_dir):
    """Cohorts are computed again with other weeks; only new users take them."""
    path = scratch_dir(spark, "cohorts")
    users = inputs.users(spark, sf_dir)
    early = reports.user_cohorts(
        users.filter(F.col("created_at") < ts("1996-01-01")), "2024-01-15"
    )
    later = reports.user_cohorts(users, "2024-01-15").withColumn(
        "cohort_week", F.date_add("cohort_week", 7)
    )
    for batch in (early, later, later):
        tables.append_absent(batch, path, ("user_id",))
    return spark.read.parquet(path)


@query(
    "landing_roundtrip",
    f"""WITH {sql.raw()}
    SELECT id, user_id, event_type, payload, product_id, CAST(amount AS DOUBLE) AS amount, created_at
    FROM raw WHERE created_at >= TIMESTAMP '2024-01-05 06:30:00'
               AND created_at < TIMESTAMP '2024-01-20'""",
)
def landing_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "landing")
    tables.replace_interval(inputs.raw_events(spark, sf_dir), path, HOURLY)
    back = read_landing(spark, path, iv=("2024-01-05 06:30:00", "2024-01-20"))
    return back.withColumn("amount", F.col("amount").cast("double"))


@query(
    "interval_reload_result",
    f"""WITH {sql.raw()}
    SELECT id, event_type, created_at FROM raw
    WHERE event_type = 'purchase' OR created_at < TIMESTAMP '2024-01-10'
       OR created_at >= TIMESTAMP '2024-01-12'""",
)
def interval_reload_result(spark, sf_dir):
    """Two days are loaded again with fewer rows; hours left without rows disappear."""
    path = scratch_dir(spark, "reload")
    events = inputs.raw_events(spark, sf_dir)
    tables.replace_interval(events, path, HOURLY)
    iv = ("2024-01-10", "2024-01-12")
    fewer = events.filter(in_interval("created_at", iv) & (F.col("event_type") == "purchase"))
    for _ in range(2):
        tables.replace_interval(fewer, path, HOURLY, iv)
    return read_landing(spark, path).select("id", "event_type", "created_at")


@query(
    "rollup_after_late_hours",
    f"""WITH {sql.raw()}, kept AS (
        SELECT * FROM raw WHERE NOT (created_at >= TIMESTAMP '2024-01-20' AND created_at < TIMESTAMP '2024-01-20 05:00:00')
    )
    SELECT date_trunc('hour', created_at) AS hour_start, event_type, COUNT(*) AS total_count,
        {sql.pct("COUNT(*)", "SUM(COUNT(*)) OVER (PARTITION BY CAST(date_trunc('hour', created_at) AS DATE))")} AS pct_of_daily,
        CAST(date_trunc('hour', created_at) AS DATE) IN (DATE '2024-01-10', DATE '2024-01-11', DATE '2024-01-20')
            AS rewritten
    FROM kept WHERE {WHOLE} GROUP BY 1, 2""",
)
def rollup_after_late_hours(spark, sf_dir):
    """Two days get their late events and five hours lose theirs; only those are counted again.

    `rewritten` tells by the time of its file whether the second run wrote an hour's day.
    """
    lake = Lake(scratch_dir(spark, "dirty-hours"))
    events = inputs.raw_events(spark, sf_dir)
    late = in_interval("created_at", ("2024-01-10", "2024-01-12"))
    incremental.extract_noted(events.filter(~late | (F.col("id") % 3 != 0)), lake, MONTH)
    incremental.rollup_changed_hours(spark, lake)
    first = _newest_file(spark, lake.gold(incremental.HOURS_TABLE))
    for rows, iv in (
        (events, ("2024-01-10", "2024-01-12")),
        (events.limit(0), ("2024-01-20", "2024-01-20 05:00:00")),
    ):
        incremental.extract_noted(rows, lake, iv)
    incremental.rollup_changed_hours(spark, lake)
    hours = spark.read.parquet(lake.gold(incremental.HOURS_TABLE)).select(
        "hour_start", "event_type", "total_count",
        (F.col("_metadata.file_modification_time") > F.lit(first)).alias("rewritten"),
    )
    shares = spark.read.parquet(lake.gold(incremental.SHARES_TABLE)).select(
        (F.col("report_date").cast("timestamp") + F.make_dt_interval(hours="event_hour")).alias("hour_start"),
        "event_type", "pct_of_daily",
    )
    return hours.join(shares, ["hour_start", "event_type"])


def _newest_file(spark, path: str):
    times = spark.read.parquet(path).select(F.col("_metadata.file_modification_time").alias("at"))
    return times.agg(F.max("at")).first()[0]


def _compacted(spark, sf_dir):
    root = scratch_dir(spark, "compaction")
    bronze, gold = f"{root}/bronze", f"{root}/gold"
    events = inputs.raw_events(spark, sf_dir)
    small_files = DAILY.assign(events, "created_at").repartition(4)
    small_files.write.partitionBy("dt").parquet(bronze)
    dates = [r.dt.isoformat() for r in partition_dates(list_files(spark, bronze)).collect()]
    return gold, lifecycle.compact(spark, bronze, gold, dates)


@query(
    "compaction_result",
    f"""WITH {sql.raw()} SELECT id, user_id, event_type, payload, created_at,
        CAST(created_at AS DATE) AS dt FROM raw""",
)
def compaction_result(spark, sf_dir):
    gold, _ = _compacted(spark, sf_dir)
    return spark.read.parquet(gold).select(
        "id", "user_id", "event_type", "payload", "created_at", "dt"
    )


@query(
    "compaction_manifest",
    """SELECT CAST(ts AS DATE) AS compaction_date, CAST(1 AS BIGINT) AS files_after,
        COUNT(*) AS rows_before, COUNT(*) AS rows_after, 'complete' AS status
    FROM events GROUP BY 1""",
)
def compaction_manifest(spark, sf_dir):
    _, manifest = _compacted(spark, sf_dir)
    return manifest.select(
        "compaction_date", "files_after", "rows_before", "rows_after", "status"
    )


CHOSEN_USERS = 5


@query(
    "pruned_user_interval",
    f"""WITH {sql.raw()}, chosen AS (
        SELECT user_id FROM raw GROUP BY 1 ORDER BY COUNT(*) DESC, user_id LIMIT {CHOSEN_USERS})
    SELECT id, user_id, event_type, created_at, true AS few_files FROM raw
    WHERE user_id IN (SELECT user_id FROM chosen)
      AND created_at >= TIMESTAMP '2024-01-05' AND created_at < TIMESTAMP '2024-01-12'""",
)
def pruned_user_interval(spark, sf_dir):
    """A week of the five users with most events, from less than a third of the files."""
    path = scratch_dir(spark, "clustered")
    events = inputs.raw_events(spark, sf_dir)
    clustering.write_clustered(events, path, 64)
    top = events.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").limit(CHOSEN_USERS)
    users = [r.user_id for r in top.collect()]
    iv = ("2024-01-05", "2024-01-12")
    index = spark.read.parquet(clustering.index_path(path))
    few = 3 * len(clustering.files_of(index, iv, users)) < index.count()
    found = clustering.read_users(spark, path, events.schema, iv, users)
    return found.select("id", "user_id", "event_type", "created_at", F.lit(few).alias("few_files"))


@query(
    "bronze_promoted",
    f"""{RANK_SQL.replace("FROM raw)", "FROM raw WHERE user_id IS NOT NULL)")}
    SELECT id, user_id, event_type, created_at FROM ranked
    WHERE rn = 1 AND event_type IN ('signup', 'click', 'view', 'purchase')""",
)
def bronze_promoted(spark, sf_dir):
    path = scratch_dir(spark, "bronze")
    clean = quality.promote_to_bronze(_with_copies(spark, sf_dir), allowed=STREAM_TYPES)
    tables.replace_interval(clean, path, DAILY)
    return spark.read.parquet(path).select("id", "user_id", "event_type", "created_at")


@query("csv_export", WEEKLY_SQL)
def csv_export(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    exports.export_csv(weekly_cohort_metrics(spark, sf_dir), path)
    schema = "cohort_week DATE, report_week DATE, event_count BIGINT, unique_users BIGINT"
    return spark.read.option("header", True).schema(schema).csv(path)


@query(
    "file_retention_plan",
    """SELECT DISTINCT CAST(ts AS DATE) AS partition_date,
        CAST(DATE '2024-02-10' - CAST(ts AS DATE) AS INTEGER) AS age_days,
        DATE '2024-02-10' - CAST(ts AS DATE) > 30 AS expired FROM events""",
)
def file_retention_plan(spark, sf_dir):
    path = scratch_dir(spark, "retention")
    tables.replace_interval(inputs.raw_events(spark, sf_dir), path, DAILY)
    return lifecycle.partition_retention_plan(list_files(spark, path), "2024-02-10")


@query(
    "tenant_landing_roundtrip",
    f"""WITH {sql.raw()}
    SELECT id, user_id, event_type, created_at, 't' || CAST(CAST(user_id AS BIGINT) % 3 AS VARCHAR) AS tenant
    FROM raw WHERE created_at >= TIMESTAMP '2024-01-05 06:30:00' AND created_at < TIMESTAMP '2024-01-20'
      AND CAST(user_id AS BIGINT) % 3 IN (0, 2)""",
)
def tenant_landing_roundtrip(spark, sf_dir):
    lake = Lake(scratch_dir(spark, "tenant-landing"))
    batch.extract_tenants(inputs.tenant_events(spark, sf_dir), lake)
    back = read_landing(
        spark,
        lake.tenant_landing,
        iv=("2024-01-05 06:30:00", "2024-01-20"),
        tenants=["t0", "t2", "absent"],
    )
    return back.select("id", "user_id", "event_type", "created_at", "tenant")


@query(
    "tenant_reload_result",
    f"""WITH {sql.raw()}, own AS (
        SELECT *, 't' || CAST(CAST(user_id AS BIGINT) % 3 AS VARCHAR) AS tenant FROM raw)
    SELECT id, event_type, created_at, tenant FROM own
    WHERE (event_type = 'purchase' AND tenant <> 't1') OR created_at < TIMESTAMP '2024-01-10'
       OR created_at >= TIMESTAMP '2024-01-12'""",
)
def tenant_reload_result(spark, sf_dir):
    """Two days are loaded again, with fewer rows and without one tenant, whose days disappear."""
    lake = Lake(scratch_dir(spark, "tenant-reload"))
    events = inputs.tenant_events(spark, sf_dir)
    batch.extract_tenants(events, lake)
    fewer = events.filter((F.col("event_type") == "purchase") & (F.col("tenant") != "t1"))
    for _ in range(2):
        batch.extract_tenants(fewer, lake, ("2024-01-10", "2024-01-12"))
    back = read_landing(spark, lake.tenant_landing, tenants=["t0", "t1", "t2"])
    return back.select("id", "event_type", "created_at", "tenant")


@query(
    "tenant_gold_report",
    f"""WITH {sql.TENANT_GOLD}
    SELECT m.tenant_id, g.product_id, COALESCE(g.total_conversions, 0)::BIGINT AS total_conversions
    FROM {sql.TENANT_DAYS} m(tenant_id, position, days)
    LEFT JOIN (SELECT * FROM tenant_gold WHERE event_type = 'purchase') g ON g.tenant_id = m.tenant_id""",
)
def tenant_gold_report(spark, sf_dir):
    """Gold from its files; one tenant of the manifest has none."""
    path = scratch_dir(spark, "tenant-gold")
    tables.replace_table(tenant_conversions(spark, sf_dir), path, ("tenant_id",))
    gold = read_tenant_gold(spark, path, inputs.manifest(spark, extra_tenant=True))
    return gold.select("tenant_id", "product_id", "total_conversions")


@query(
    "tenant_conversions_by_manifest_file",
    f"""WITH {sql.TENANT_GOLD} SELECT product_id, event_type, total_conversions, tenant_id
    FROM tenant_gold WHERE event_type = 'purchase'""",
)
def tenant_conversions_by_manifest_file(spark, sf_dir):
    path = scratch_dir(spark, "manifest")
    entries = inputs.manifest(spark).orderBy("position").drop("position")
    entries.agg(F.to_json(F.collect_list(F.struct(*entries.columns))).alias("value")).write.text(path)
    return tenants.tenant_conversions(
        inputs.tenant_events(spark, sf_dir), read_manifest(spark, path), AS_OF
    )


WINDOWS = ((START, "2024-01-16"), ("2024-01-16", END))


@query(
    "windowed_gold",
    f"""WITH {sql.raw()}
    SELECT product_id, CASE WHEN created_at < TIMESTAMP '2024-01-16' THEN 'w1' ELSE 'w2' END AS "window",
        MIN(CASE WHEN created_at < TIMESTAMP '2024-01-16' THEN TIMESTAMP '2024-01-01'
                 ELSE TIMESTAMP '2024-01-16' END) AS window_start,
        COUNT(*) AS total_conversions
    FROM raw WHERE {WHOLE} AND event_type = 'purchase' GROUP BY 1, 2""",
)
def windowed_gold(spark, sf_dir):
    """Gold keeps both windows; running one again replaces that one. Without processed_at."""
    path = scratch_dir(spark, "windows")
    events = inputs.raw_events(spark, sf_dir)
    for label, iv in (("w1", WINDOWS[0]), ("w2", WINDOWS[1]), ("w1", WINDOWS[0])):
        gold = reports.with_audit_columns(reports.product_conversions(events, iv), iv)
        tables.replace_window(gold, path, label)
    stored = spark.read.parquet(path)
    return stored.select("product_id", "window", "window_start", "total_conversions")


@query(
    "measurement_log",
    """SELECT event_type, COUNT(*) AS event_count, CAST(r AS INTEGER) AS run
    FROM events, (VALUES (1), (2)) runs(r) GROUP BY ALL""",
)
def measurement_log(spark, sf_dir):
    path = scratch_dir(spark, "log")
    counts = inputs.raw_events(spark, sf_dir).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count")
    )
    for run in (1, 2):
        tables.append_log(counts.withColumn("run", F.lit(run)), path)
    return spark.read.parquet(path)


@query(
    "rows_out_of_order",
    "SELECT CAST(ts AS DATE) AS dt, CAST(0 AS BIGINT) AS rows_out_of_order FROM events GROUP BY 1",
)
def rows_out_of_order(spark, sf_dir):
    """Rows of a landing file that are older than the row before them: none."""
    path = scratch_dir(spark, "order")
    tables.replace_interval(inputs.raw_events(spark, sf_dir), path, DAILY)
    rows = spark.read.parquet(path).select(
        "dt",
        "created_at",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("at"),
    )
    before = F.lag("created_at").over(Window.partitionBy("file").orderBy("at"))
    return (
        rows.withColumn("late", before > F.col("created_at"))
        .groupBy("dt")
        .agg(F.count_if("late").alias("rows_out_of_order"))
    )


# -- messages and streams -----------------------------------------------------


def _classified(spark, sf_dir):
    return messages.classify_messages(
        inputs.messages(spark, sf_dir), allowed=STREAM_TYPES, as_of=AS_OF
    )


@query(
    "dlq_fixable",
    f"""WITH {sql.MESSAGES}
    SELECT partition, "offset", event_type,
           regexp_replace(value, '\\s*\\}}\\s*$', '')
           || CASE WHEN has_product THEN '' ELSE ', "product_id": null' END
           || CASE WHEN has_time THEN '' ELSE ', "timestamp": "2024-01-31T00:00:00"' END || '}}'
               AS fixed_value
    FROM classified WHERE reason IS NULL""",
)
def dlq_fixable(spark, sf_dir):
    fixable, _ = messages.split_valid_dlq(_classified(spark, sf_dir))
    return fixable.select("partition", "offset", "event_type", "fixed_value")


@query(
    "dlq_unrecoverable",
    f"""WITH {sql.MESSAGES}
    SELECT "offset" AS kafka_offset, partition, substring(value, 1, 2000) AS raw_value, reason
    FROM classified WHERE reason IS NOT NULL""",
)
def dlq_unrecoverable(spark, sf_dir):
    _, unrecoverable = messages.split_valid_dlq(_classified(spark, sf_dir))
    return messages.unrecoverable_log(unrecoverable, messages.MAX_LOGGED_CHARS)


@query(
    "dlq_bounded_batch",
    f"""WITH {sql.MESSAGES}
    SELECT partition, "offset", value FROM messages ORDER BY partition, "offset" LIMIT 500""",
)
def dlq_bounded_batch(spark, sf_dir):
    sent = inputs.messages(spark, sf_dir)
    source = _stream_files(spark, sent.drop("timestamp"), "dead-letters")
    return read_dlq(spark, "parquet", max_messages=500, path=source)


@query(
    "dlq_offset_ranges",
    f"""WITH {sql.MESSAGES}, bounds AS (
        SELECT partition, MIN("offset") AS low, MAX("offset") + 1 AS high FROM messages
        WHERE partition < 3 OR "offset" >= 40 GROUP BY 1
    ), done(partition, next) AS (VALUES (0, 70), (1, 0), (3, 15), (9, 5)), planned AS (
        SELECT COALESCE(b.partition, d.partition) AS partition,
            CASE WHEN high IS NULL THEN next WHEN next IS NULL OR next < low THEN low ELSE next END AS starting,
            COALESCE(high, next) AS stop, CASE WHEN next < low THEN low - next ELSE 0 END AS lost,
            CASE WHEN high IS NULL THEN 'vanished' WHEN next IS NULL THEN 'new'
                 WHEN next < low THEN 'gap' WHEN next = high THEN 'idle' ELSE 'lagging' END AS status
        FROM bounds b FULL JOIN done d ON d.partition = b.partition
    ), counted AS (
        SELECT *, SUM(stop - starting) OVER (ORDER BY partition) - (stop - starting) AS before FROM planned
    ), ranges AS (
        SELECT *, starting + LEAST(stop - starting, GREATEST(0, 600 - before)) AS ending FROM counted
    )
    SELECT CAST(r.partition AS INTEGER) AS partition, CAST(starting AS BIGINT) AS starting,
        CAST(ending AS BIGINT) AS ending, CAST(lost AS BIGINT) AS lost, status,
        COUNT(m."offset") AS messages, MIN(m.value) AS least_value
    FROM ranges r LEFT JOIN messages m ON m.partition = r.partition
         AND m."offset" >= starting AND m."offset" < ending
    GROUP BY ALL""",
)
def dlq_offset_ranges(spark, sf_dir):
    """A read of at most 600 offsets, planned from stored progress and the topic's bounds, with
    a partition that is new, one that lost messages to retention, and one that vanished."""
    sent = inputs.messages(spark, sf_dir).drop("timestamp")
    source = _stream_files(spark, sent.filter("partition < 3 OR offset >= 40"), "ranges")
    done = spark.createDataFrame([(0, 70), (1, 0), (3, 15), (9, 5)], schemas.REPLAY_OFFSETS)
    plan = plan_offsets(done, dlq_bounds(spark, "parquet", path=source), 600)
    read = read_dlq(spark, "parquet", plan=plan.collect(), path=source)
    found = read.groupBy("partition").agg(
        F.count(F.lit(1)).alias("messages"), F.min("value").alias("least_value")
    )
    return plan.join(found, "partition", "left").fillna(0, ["messages"])


FIXED_SQL = f"""WITH {sql.MESSAGES}
    SELECT regexp_replace(value, '\\s*\\}}\\s*$', '')
           || CASE WHEN has_product THEN '' ELSE ', "product_id": null' END
           || CASE WHEN has_time THEN '' ELSE ', "timestamp": "2024-01-31T00:00:00"' END || '}}'
               AS value
    FROM classified WHERE reason IS NULL"""


@query("republished_messages", FIXED_SQL)
def republished_messages(spark, sf_dir):
    path = scratch_dir(spark, "republished")
    fixable, _ = messages.split_valid_dlq(_classified(spark, sf_dir))
    exports.republish(fixable.select(F.col("fixed_value").alias("value")), "text", path=path)
    return spark.read.text(path)


@query("dlq_replay_twice", FIXED_SQL.replace("('signup', 'click', 'view', 'purchase')", "('view', 'purchase')"))
def dlq_replay_twice(spark, sf_dir):
    """The second and third run see the whole topic and republish only what came since."""
    lake = Lake(scratch_dir(spark, "replay"))
    source, target = f"{lake.root}/dead-letters", f"{lake.root}/main"
    sent = inputs.messages(spark, sf_dir).drop("timestamp")
    # Half of the messages come later, whatever the size of the input.
    middle = F.col("offset") < sent.agg(F.median("offset")).first()[0]
    for part in (sent.filter(middle), sent.filter(~middle), sent.limit(0)):
        part.write.mode("append").parquet(source)
        checks.replay_dead_letters(
            spark, lake, AS_OF, "parquet", "text", {"path": source}, {"path": target}
        )
    return spark.read.text(target)


def _stream_files(spark, rows, name: str) -> str:
    path = scratch_dir(spark, name)
    rows.write.parquet(path)
    return path


@query("stream_minute_counts", f"WITH {sql.MINUTES} SELECT * FROM minutes")
def stream_minute_counts(spark, sf_dir):
    """Replay the events as messages through the streaming path into an upserted table."""
    events = inputs.raw_events(spark, sf_dir)
    sent = events.select(
        F.to_json(
            F.struct(
                F.col("user_id").alias("userId"),
                F.col("event_type").alias("eventType"),
                F.col("product_id").alias("productId"),
                F.col("created_at").alias("timestamp"),
            )
        ).alias("value"),
        F.col("created_at").alias("timestamp"),
    )
    root = scratch_dir(spark, "live-metrics")
    _live(spark, _stream_files(spark, sent, "messages"), root)
    return _live_table(spark, root)


def _live_table(spark, root):
    return spark.read.parquet(f"{root}/table").select(
        "window_start", "window_end", "event_type", "event_count"
    )


@query(
    "stream_without_late_rows",
    f"WITH {sql.MINUTES} SELECT * FROM minutes",
)
def stream_without_late_rows(spark, sf_dir):
    """All events once more, a day after the last of them: beyond the watermark, so not counted."""
    kind = F.to_json(F.struct(F.col("event_type").alias("eventType"))).alias("value")
    sent = inputs.raw_events(spark, sf_dir).select(kind, F.col("created_at").alias("timestamp"))
    source, root = _stream_files(spark, sent, "messages"), scratch_dir(spark, "late")
    _live(spark, source, root)
    last = sent.agg(F.max("timestamp").alias("last"))
    later = last.select(F.lit("{}").alias("value"), F.expr("last + INTERVAL 1 DAY").alias("timestamp"))
    later.write.mode("append").parquet(source)
    _live(spark, source, root)
    sent.write.mode("append").parquet(source)
    _live(spark, source, root)
    return _live_table(spark, root).filter("event_type IS NOT NULL")


def _live(spark, source: str, root: str) -> None:
    stream = read_event_stream(
        spark, "parquet", "value STRING, timestamp TIMESTAMP", path=source
    )
    running = write_stream_upsert(
        minute_counts(decode_events(stream)),
        f"{root}/table",
        f"{root}/checkpoint",
        trigger={"availableNow": True},
        state_partitions=8,
    )
    running.awaitTermination()


def _late_stream(spark, sf_dir) -> str:
    """Three runs of one stream: all events; half of a day's events a day after the last one,
    on time; and all events again, which are late by then."""
    kind = F.to_json(F.struct(F.col("event_type").alias("eventType"))).alias("value")
    sent = inputs.raw_events(spark, sf_dir).select(kind, F.col("created_at").alias("timestamp"))
    source, root = scratch_dir(spark, "messages"), scratch_dir(spark, "late-rows")
    newest = sent.agg(F.max("timestamp").alias("newest"))
    last_day = sent.join(F.broadcast(newest), F.expr("timestamp > newest - INTERVAL 1 DAY"))
    later = last_day.select("value", F.expr("timestamp + INTERVAL 2 DAYS").alias("timestamp"))
    for rows in (sent, later, sent):
        rows.write.mode("append").parquet(source)
        stream = read_event_stream(spark, "parquet", "value STRING, timestamp TIMESTAMP", path=source)
        running = write_stream_counts(
            decode_events(stream),
            f"{root}/totals",
            f"{root}/late",
            f"{root}/marks",
            f"{root}/checkpoint",
            trigger={"availableNow": True},
        )
        running.awaitTermination()
    return root


@query(
    "stream_late_rows",
    """SELECT ts AS event_time, event_type,
        date_trunc('milliseconds', (SELECT max(ts) FROM events)) + INTERVAL 2 DAY - INTERVAL 2 MINUTE
            AS watermark
    FROM events""",
)
def stream_late_rows(spark, sf_dir):
    """Exactly the rows that were not counted, with the watermark they missed."""
    late = spark.read.parquet(f"{_late_stream(spark, sf_dir)}/late")
    return late.select(F.col("kafka_ts").alias("event_time"), "event_type", "watermark")


@query(
    "stream_counts_and_late_rows",
    """WITH sent AS (
        SELECT ts, event_type, 1 AS counted, 0 AS late FROM events
        UNION ALL SELECT ts, event_type, 0, 1 FROM events
        UNION ALL SELECT ts + INTERVAL 2 DAY, event_type, 1, 0 FROM events
        WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY
    )
    SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, event_type,
        CAST(SUM(counted) AS BIGINT) AS counted, CAST(SUM(late) AS BIGINT) AS late
    FROM sent GROUP BY 1, 2""",
)
def stream_counts_and_late_rows(spark, sf_dir):
    """Counted and late rows of every window: together, all that were sent."""
    root = _late_stream(spark, sf_dir)
    counted = spark.read.parquet(f"{root}/totals").select(
        "window_start", "event_type", F.col("event_count").alias("counted"), F.lit(0).alias("late")
    )
    late = spark.read.parquet(f"{root}/late").select(
        "window_start", "event_type", F.lit(0).cast("long").alias("counted"), F.lit(1).alias("late")
    )
    return counted.unionByName(late).groupBy("window_start", "event_type").agg(
        F.sum("counted").alias("counted"), F.sum("late").alias("late")
    )


@query(
    "stream_deduplicated_minutes",
    """WITH once AS (
        SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, event_type, date_trunc('second', ts) AS slot
        FROM events
    )
    SELECT date_trunc('minute', slot) AS window_start,
        date_trunc('minute', slot) + INTERVAL 1 MINUTE AS window_end, event_type, COUNT(*) AS event_count
    FROM once GROUP BY ALL""",
)
def stream_deduplicated_minutes(spark, sf_dir):
    """Events with copies, in two runs of one stream; the second begins with the last hour of
    the first once more. State alone tells that those are copies."""
    rows = inputs.raw_events(spark, sf_dir, copies=True)
    sent = rows.select(
        F.to_json(
            F.struct(F.col("user_id").alias("userId"), F.col("event_type").alias("eventType"))
        ).alias("value"),
        F.col("created_at").alias("timestamp"),
    )
    middle = F.lit("2024-01-16").cast("timestamp")
    source, root = scratch_dir(spark, "messages"), scratch_dir(spark, "deduplicated")
    at = F.col("timestamp")
    for part in (sent.filter(at < middle), sent.filter(at >= middle - F.expr("INTERVAL 1 HOUR"))):
        part.write.mode("append").parquet(source)
        stream = read_event_stream(spark, "parquet", "value STRING, timestamp TIMESTAMP", path=source)
        first = first_copies(decode_events(stream), watermark="1 hour")
        running = write_stream_upsert(
            minute_counts(first, watermark=None),
            f"{root}/table",
            f"{root}/checkpoint",
            trigger={"availableNow": True},
            state_partitions=8,
        )
        running.awaitTermination()
    return _live_table(spark, root)


@query(
    "stream_state_health",
    f"""WITH {sql.MINUTES}, open AS (
        SELECT * FROM minutes WHERE window_end > (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE
    )
    SELECT COUNT(*) AS state_rows, CAST(SUM(event_count) AS BIGINT) AS open_events,
        MIN(window_start) AS oldest_window, MAX(window_start) AS newest_window,
        CAST(epoch(TIMESTAMP '2024-02-10') - epoch(MIN(window_start)) AS BIGINT) AS oldest_age_s,
        CAST(0 AS BIGINT) AS differing, 8 AS stores,
        (SELECT COUNT(*) FROM events) AS input_rows,
        date_trunc('milliseconds', (SELECT max(ts) FROM events)) - INTERVAL 2 MINUTE AS watermark
    FROM open""",
)
def stream_state_health(spark, sf_dir):
    """The open windows of a stream that has read all events, its progress, and how many open
    windows differ from the table of counts."""
    sent = inputs.raw_events(spark, sf_dir).select(
        F.to_json(F.struct(F.col("event_type").alias("eventType"))).alias("value"),
        F.col("created_at").alias("timestamp"),
    )
    root = scratch_dir(spark, "state")
    log = health.ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    try:
        _live(spark, _stream_files(spark, sent, "messages"), root)
        progress = _settled(spark, f"{root}/progress")
    finally:
        spark.streams.removeListener(log)
    state = health.window_state(spark, f"{root}/checkpoint")
    differing = state.exceptAll(_live_table(spark, root).select(*state.columns)).count()
    # One row each.
    stores = health.state_stores(spark, f"{root}/checkpoint").first().stores
    last = health.latest_progress(progress, "2024-02-10").first()
    return health.state_health(state, "2024-02-10").withColumns(
        {
            "differing": F.lit(differing).cast("long"),
            "stores": F.lit(stores),
            "input_rows": F.lit(last.total_input_rows).cast("long"),
            "watermark": F.lit(last.watermark).cast("timestamp"),
        }
    )


def _settled(spark, path: str):
    """The progress once the listener, which runs beside the stream, has written its last batch."""
    for _ in range(100):
        rows = health.read_progress(spark, path)
        if not rows.filter("watermark > TIMESTAMP '2000-01-01'").isEmpty():
            break
        time.sleep(0.1)
    return health.read_progress(spark, path)


@query(
    "stream_valid_dlq_split",
    f"""WITH {sql.MESSAGES}
    SELECT partition, "offset", CASE WHEN reason IS NULL THEN 'valid' ELSE 'dlq' END AS route, reason
    FROM classified""",
)
def stream_valid_dlq_split(spark, sf_dir):
    """Two streams with checkpoints of their own write to the same tables."""
    sent = inputs.messages(spark, sf_dir)
    source = _stream_files(spark, sent, "raw-messages")
    stream = read_event_stream(spark, "parquet", sent.schema, path=source)
    root = scratch_dir(spark, "split")
    for turn in (0, 1):
        own = stream.filter(F.pmod("offset", F.lit(2)) == turn)
        running = write_stream_split(
            own,
            f"{root}/valid",
            f"{root}/dlq",
            f"{root}/checkpoint-{turn}",
            STREAM_TYPES,
            trigger={"availableNow": True},
        )
        running.awaitTermination()
    valid = spark.read.parquet(f"{root}/valid").select(
        "partition", "offset", F.lit("valid").alias("route"), F.lit(None).cast("string").alias("reason")
    )
    dlq = spark.read.parquet(f"{root}/dlq").select(
        "partition", "offset", F.lit("dlq").alias("route"), "reason"
    )
    return valid.unionByName(dlq)

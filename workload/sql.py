"""SQL fragments shared by the oracle queries; they mirror workload.inputs."""

from __future__ import annotations

from workload.inputs import (
    COPY_EVERY,
    COPY_ID_OFFSET,
    MESSY_AMOUNT_EVERY,
    NULL_USER_EVERY,
    TENANTS,
)


def raw(null_users: bool = False, copies: bool = False, messy_amounts: bool = False) -> str:
    user = "CAST(user_id AS VARCHAR)"
    if null_users:
        user = f"CASE WHEN event_id % {NULL_USER_EVERY} <> 0 THEN {user} END"
    shown = "CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)"
    if messy_amounts:
        shown = f"""CASE event_id % {MESSY_AMOUNT_EVERY}
            WHEN 0 THEN '"1.2.3"' WHEN 1 THEN 'null' WHEN 2 THEN '"abc"' ELSE {shown} END"""
    k = "json_extract_string(props, '$.k')"
    body = f"""SELECT event_id AS id, {user} AS user_id, event_type,
        '{{"product_id": ' || {k} || ', "amount": ' || {shown} || '}}' AS payload,
        CAST({k} AS INTEGER) AS product_id, CAST(value AS DECIMAL(12,2)) AS amount,
        ts AS created_at FROM events"""
    if copies:
        body = f"""SELECT * FROM ({body}) UNION ALL
            SELECT id + {COPY_ID_OFFSET}, user_id, event_type, payload, product_id, amount, created_at
            FROM ({body}) WHERE id % {COPY_EVERY} = 0"""
    return f"raw AS ({body})"


USERS = """users AS (
    SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS email, created_at,
           CASE WHEN c_custkey % 11 = 0
                THEN CAST(CAST(created_at AS DATE) + 30 AS TIMESTAMP) END AS deleted_at
    FROM (SELECT c_custkey, c_name,
                 COALESCE(first_order, TIMESTAMP '1995-01-01') AS created_at
          FROM customer LEFT JOIN
               (SELECT o_custkey, MIN(o_orderdate) AS first_order FROM orders GROUP BY 1) f
               ON c_custkey = o_custkey))"""

MINUTES = """minutes AS (
    SELECT date_trunc('minute', ts) AS window_start,
           date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
           event_type, COUNT(*) AS event_count
    FROM events GROUP BY ALL)"""

TASKS = """tasks AS (
    SELECT o_orderpriority AS dag_id, 'task_' || CAST(o_custkey % 7 AS VARCHAR) AS task_id,
           CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'success' END AS state,
           o_orderdate AS start_date, o_orderkey AS try_number
    FROM orders)"""

TENANT_DAYS = "(VALUES ('t0', 0, 7), ('t1', 1, 14), ('t2', 2, 30), ('t3', 3, 30))"

TENANT_GOLD = f"""tenant_gold AS (
    SELECT e.tenant_id, e.product_id, e.event_type, COUNT(*) AS total_conversions
    FROM (SELECT 't' || CAST(user_id % {TENANTS} AS VARCHAR) AS tenant_id, event_type, ts,
                 CAST(json_extract_string(props, '$.k') AS INTEGER) AS product_id FROM events) e
    JOIN {TENANT_DAYS} m(tenant_id, position, days) ON m.tenant_id = e.tenant_id
    WHERE e.ts < TIMESTAMP '2024-01-31'
      AND e.ts >= TIMESTAMP '2024-01-31' - to_days(CAST(m.days AS INTEGER))
    GROUP BY ALL)"""

MESSAGES = """messages AS (
    SELECT CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset", ts,
        CASE event_id % 10
            WHEN 0 THEN '{"user_id": "' || CAST(user_id AS VARCHAR)
            WHEN 1 THEN '{"event_type": "' || event_type || '"}'
            WHEN 2 THEN '[1]'
            WHEN 3 THEN intact || ' {"again": 1}'
            WHEN 4 THEN '{"user_id": null, "event_type": "' || event_type
                        || '", "product_id": 5, "timestamp": "2024-01-01T00:00:00"}'
            WHEN 5 THEN '{"event_type": "bad", "user_id": "' || CAST(user_id AS VARCHAR)
                        || '", "event_type": "' || event_type || '"}'
            WHEN 6 THEN '{"event_type": "' || event_type || '", "user_id": "' || CAST(user_id AS VARCHAR)
                        || '", "event_type": "bad"}'
            ELSE intact END AS value,
        CASE event_id % 10 WHEN 5 THEN event_type WHEN 6 THEN 'bad' END AS last_type
    FROM (SELECT *, '{"user_id": "' || CAST(user_id AS VARCHAR) || '", "event_type": "'
                    || event_type || '", "nested": ' || props || '}' AS intact FROM events)),
classified AS (
    SELECT *, CASE
        WHEN NOT valid THEN 'invalid_json'
        WHEN NOT has_type AND NOT has_user THEN 'missing_required: event_type, user_id'
        WHEN NOT has_type THEN 'missing_required: event_type'
        WHEN NOT has_user THEN 'missing_required: user_id'
        WHEN event_type IS NULL OR event_type NOT IN ('signup', 'click', 'view', 'purchase')
            THEN 'invalid_event_type: ' || COALESCE(event_type, 'None')
        END AS reason
    FROM (SELECT *,
            COALESCE(list_contains(json_keys(doc), 'user_id'), false) AS has_user,
            COALESCE(list_contains(json_keys(doc), 'event_type'), false) AS has_type,
            COALESCE(list_contains(json_keys(doc), 'product_id'), false) AS has_product,
            COALESCE(list_contains(json_keys(doc), 'timestamp'), false) AS has_time,
            COALESCE(last_type, json_extract_string(doc, '$.event_type')) AS event_type
          FROM (SELECT *, CASE WHEN valid THEN CAST(value AS JSON) END AS doc
                FROM (SELECT *, CASE WHEN json_valid(value)
                                     THEN json_type(value) = 'OBJECT' ELSE false END AS valid
                      FROM messages))))"""


def pct(part: str, total: str) -> str:
    """Percentage with two decimals, half up, as a double."""
    return (
        f"CAST((CAST({part} AS BIGINT) * 20000 + CAST({total} AS BIGINT))"
        f" // (2 * NULLIF(CAST({total} AS BIGINT), 0)) AS DOUBLE) / 100"
    )


def hour_spine(start: str, end: str) -> str:
    return (
        f"(SELECT unnest(generate_series(TIMESTAMP '{start}',"
        f" TIMESTAMP '{end}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS window_start)"
    )

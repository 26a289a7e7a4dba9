"""Independent SQL (DuckDB dialect) for every catalogued query.

Written from the semantics, not generated from the Spark plans, so that a
match is evidence.  Tables ``events`` and ``part`` are views over the same
parquet files the Spark side reads.

DuckDB notes: ``sum`` of integers is HUGEINT (cast to BIGINT);
``row_number`` is BIGINT (cast to INTEGER); a double ``0.0`` must be cast
(a bare literal is DECIMAL); ``regexp_replace`` needs ``'g'`` to replace
every match.
"""

from __future__ import annotations

from ..schema import (
    DEFAULT_TOP_N,
    FUNNEL_COLUMNS,
    PREVIEW_ROWS,
    REPORT_TOP_K,
    TRENDING_COLUMNS,
)

RAW = """
raw AS (
  SELECT
    CAST(e.user_id AS VARCHAR) AS user_id,
    CAST(e.user_id AS VARCHAR) || '-' || strftime(
        CASE WHEN e.user_id % 2 = 1 THEN e.ts + INTERVAL 12 HOUR ELSE e.ts END, '%Y-%m-%d') AS session_id,
    CASE WHEN e.event_id % 97 = 0 THEN 'garbage'
         WHEN e.event_id % 3 = 0 THEN CAST(e.ts AS VARCHAR)
         WHEN e.event_id % 3 = 1 THEN replace(CAST(e.ts AS VARCHAR), ' ', 'T') || 'Z'
         ELSE CAST(e.ts + INTERVAL 2 HOUR AS VARCHAR) || '+02:00' END AS "timestamp",
    ' ' || upper(CASE WHEN e.event_type = 'click' THEN 'add_to_cart' ELSE e.event_type END) AS action,
    'p' || json_extract_string(e.props, '$.k') AS product_id,
    p.p_type AS category,
    CASE WHEN e.event_id % 50 = 0 THEN CAST(NULL AS DOUBLE)
         WHEN e.event_id % 53 = 0 THEN CAST(0.0 AS DOUBLE)
         ELSE CAST(e.value AS DOUBLE) END AS price,
    CASE WHEN e.event_id % 41 = 0 THEN 'tv'
         WHEN CASE WHEN e.event_id % 5 = 0 THEN e.event_id ELSE e.user_id END % 3 = 0 THEN 'Mobile'
         WHEN CASE WHEN e.event_id % 5 = 0 THEN e.event_id ELSE e.user_id END % 3 = 1 THEN 'desktop'
         ELSE 'tablet' END AS device_type
  FROM events e
  LEFT JOIN part p
    ON p.p_partkey = TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) + 1
)"""

CLEAN = """
norm AS (
  SELECT
    trim(user_id) AS user_id,
    trim(session_id) AS session_id,
    CASE WHEN regexp_matches("timestamp", '^\\s*[+-]?[0-9]{4}')
         THEN CASE WHEN "timestamp" LIKE '%+02:00'
                   THEN try_cast(replace("timestamp", '+02:00', '') AS TIMESTAMP) - INTERVAL 2 HOUR
                   ELSE try_cast(replace(replace("timestamp", 'T', ' '), 'Z', '') AS TIMESTAMP) END
         END AS event_ts,
    lower(trim(action)) AS action,
    trim(product_id) AS product_id,
    trim(category) AS category,
    CAST(price AS DOUBLE) AS price,
    lower(trim(device_type)) AS device_type
  FROM raw
),
clean AS (
  SELECT * FROM norm
  WHERE user_id IS NOT NULL
    AND session_id IS NOT NULL
    AND event_ts IS NOT NULL
    AND action IN ('view', 'add_to_cart', 'purchase')
    AND product_id IS NOT NULL
    AND category IS NOT NULL
    AND price IS NOT NULL AND price >= 0.01
    AND device_type IN ('mobile', 'desktop', 'tablet')
)"""

SESSIONS = """
sess_agg AS (
  SELECT user_id, session_id,
    min(event_ts) AS session_start_ts,
    max(event_ts) AS session_end_ts,
    count(*) AS event_count,
    count(*) FILTER (WHERE action = 'view') AS view_count,
    count(*) FILTER (WHERE action IN ('add_to_cart', 'purchase')) AS meaningful_action_count
  FROM clean GROUP BY user_id, session_id
),
sessions AS (
  SELECT user_id, session_id, session_start_ts, session_end_ts, event_count, view_count,
    meaningful_action_count,
    CAST(epoch(date_trunc('second', session_end_ts)) AS BIGINT)
      - CAST(epoch(date_trunc('second', session_start_ts)) AS BIGINT) AS session_duration_seconds,
    CASE WHEN meaningful_action_count = 0 THEN 1 ELSE 0 END AS is_bounce
  FROM sess_agg
)"""

USERS = """
user_all AS (
  SELECT user_id,
    avg(session_duration_seconds) AS avg_session_duration_seconds,
    CAST(sum(is_bounce) AS DOUBLE) / count(*) AS bounce_rate,
    CAST(sum(event_count) AS BIGINT) AS total_activity_count,
    avg(event_count) AS avg_activity_count_per_session,
    count(*) AS sessions_count,
    CAST(sum(session_duration_seconds) AS BIGINT) AS total_duration
  FROM sessions GROUP BY user_id
),
users AS (
  SELECT user_id, avg_session_duration_seconds, bounce_rate, total_activity_count,
    avg_activity_count_per_session, sessions_count
  FROM user_all
)"""

PURCHASES = """
purchases AS (
  SELECT category, product_id, count(*) AS purchase_count
  FROM clean WHERE action = 'purchase' GROUP BY category, product_id
)"""


def _trending(n: int) -> str:
    return f"""
ranked AS (
  SELECT category, product_id, purchase_count,
    CAST(row_number() OVER (PARTITION BY category
         ORDER BY purchase_count DESC, product_id ASC) AS INTEGER) AS rn
  FROM purchases
),
trending AS (SELECT category, product_id, purchase_count, rn FROM ranked WHERE rn <= {n})"""


SLICES = """
slices AS (
  SELECT CAST(event_ts AS DATE) AS event_date, category, device_type, user_id, session_id,
    min(event_ts) AS first_ts,
    max(event_ts) AS last_ts,
    count(*) AS n_events,
    count(*) FILTER (WHERE action = 'view') AS n_view,
    count(*) FILTER (WHERE action = 'add_to_cart') AS n_add_to_cart,
    count(*) FILTER (WHERE action = 'purchase') AS n_purchase
  FROM clean
  GROUP BY CAST(event_ts AS DATE), category, device_type, user_id, session_id
)"""

FUNNEL = """
fcounts AS (
  SELECT event_date, category, device_type,
    count(*) FILTER (WHERE n_view > 0) AS sessions_with_view,
    count(*) FILTER (WHERE n_add_to_cart > 0) AS sessions_with_add_to_cart,
    count(*) FILTER (WHERE n_purchase > 0) AS sessions_with_purchase,
    count(*) AS sessions_total
  FROM slices GROUP BY event_date, category, device_type
),
funnel AS (
  SELECT *,
    CASE WHEN sessions_with_view > 0
         THEN CAST(sessions_with_add_to_cart AS DOUBLE) / sessions_with_view
         ELSE CAST(0.0 AS DOUBLE) END AS view_to_add_to_cart_rate,
    CASE WHEN sessions_with_add_to_cart > 0
         THEN CAST(sessions_with_purchase AS DOUBLE) / sessions_with_add_to_cart
         ELSE CAST(0.0 AS DOUBLE) END AS add_to_cart_to_purchase_rate,
    CASE WHEN sessions_with_view > 0
         THEN CAST(sessions_with_purchase AS DOUBLE) / sessions_with_view
         ELSE CAST(0.0 AS DOUBLE) END AS view_to_purchase_rate
  FROM fcounts
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _cols(names) -> str:
    return ", ".join(names)


_BASE = (RAW, CLEAN)
_TREND = (RAW, CLEAN, PURCHASES, _trending(DEFAULT_TOP_N))
_USERS = (RAW, CLEAN, SESSIONS, USERS)
_FUNNEL = (RAW, CLEAN, SLICES, FUNNEL)
_ALL = (RAW, CLEAN, SESSIONS, USERS, PURCHASES, _trending(DEFAULT_TOP_N), SLICES, FUNNEL)


def _contract_row(name: str, missing: str, present: tuple[str, ...], source: str) -> str:
    fields = ", ".join(f"{c} := {c}" for c in present)
    return (
        f"SELECT '{name}' AS table_name, '{missing}' AS missing_columns, "
        f"'{','.join(present)}' AS present_columns, count(*) AS row_count, count(*) = 0 AS is_empty, "
        f"(SELECT CAST(to_json(struct_pack({fields})) AS VARCHAR) FROM {source} "
        f"ORDER BY {', '.join(present)} LIMIT 1) AS preview FROM {source}"
    )


def oracle_sql() -> dict[str, str]:
    raw_cols = "user_id, session_id, \"timestamp\", action, product_id, category, price, device_type"
    q: dict[str, str] = {}
    q["raw_events"] = _with(RAW) + f"SELECT {raw_cols} FROM raw"
    q["clean_events"] = _with(*_BASE) + (
        "SELECT user_id, session_id, event_ts, action, product_id, category, price, device_type "
        "FROM clean"
    )
    q["session_facts"] = _with(RAW, CLEAN, SESSIONS) + "SELECT * FROM sessions"
    q["session_facts_from_slices"] = q["session_facts"]
    q["user_session_metrics"] = _with(*_USERS) + "SELECT * FROM users"
    q["user_metrics_documented"] = _with(*_USERS) + (
        "SELECT user_id, total_duration, total_activity_count AS total_actions FROM user_all"
    )
    q["product_purchases"] = _with(RAW, CLEAN, PURCHASES) + "SELECT * FROM purchases"
    q["trending_products"] = _with(*_TREND) + f"SELECT {_cols(TRENDING_COLUMNS)} FROM trending"
    q["trending_products_top1"] = _with(RAW, CLEAN, PURCHASES, _trending(1)) + (
        f"SELECT {_cols(TRENDING_COLUMNS)} FROM trending"
    )
    q["trending_sorted"] = _with(*_TREND) + (
        f"SELECT {_cols(TRENDING_COLUMNS)} FROM trending ORDER BY category, rn"
    )
    q["trending_documented"] = _with(*_TREND) + (
        "SELECT product_id, category, purchase_count AS count FROM trending"
    )
    q["session_slices"] = _with(RAW, CLEAN, SLICES) + "SELECT * FROM slices"
    q["session_slice_flags"] = _with(RAW, CLEAN, SLICES) + (
        "SELECT event_date, category, device_type, user_id, session_id, "
        "CASE WHEN n_view > 0 THEN 1 ELSE 0 END AS has_view, "
        "CASE WHEN n_add_to_cart > 0 THEN 1 ELSE 0 END AS has_add_to_cart, "
        "CASE WHEN n_purchase > 0 THEN 1 ELSE 0 END AS has_purchase FROM slices"
    )
    q["conversion_funnel"] = _with(*_FUNNEL) + f"SELECT {_cols(FUNNEL_COLUMNS)} FROM funnel"
    q["funnel_documented"] = _with(*_FUNNEL) + (
        "SELECT event_date, category, device_type, sessions_with_view AS view_count, "
        "sessions_with_add_to_cart AS cart_count, sessions_with_purchase AS purchase_count "
        "FROM funnel"
    )
    q["kpi_summary"] = _with(*_USERS) + (
        "SELECT count(DISTINCT user_id) AS total_users, "
        "CAST(trunc(coalesce(sum(coalesce(try_cast(total_activity_count AS DOUBLE), "
        "CAST(0.0 AS DOUBLE))), CAST(0.0 AS DOUBLE))) AS BIGINT) AS total_actions FROM users"
    )
    lenient = "coalesce(sum(coalesce(try_cast({c} AS DOUBLE), CAST(0.0 AS DOUBLE))), CAST(0.0 AS DOUBLE))"
    stage_cols = ("sessions_with_view", "sessions_with_add_to_cart", "sessions_with_purchase")
    totals = "\ntot AS (SELECT " + ", ".join(
        f"{lenient.format(c=c)} AS s{i}" for i, c in enumerate(stage_cols, 1)
    ) + " FROM funnel)"
    q["funnel_totals"] = _with(*_FUNNEL, totals) + (
        "SELECT 1 AS step, 'view' AS stage, s1 AS count FROM tot UNION ALL "
        "SELECT 2, 'cart', s2 FROM tot UNION ALL SELECT 3, 'purchase', s3 FROM tot"
    )
    q["trending_top10"] = _with(*_TREND) + (
        "SELECT product_id, category, coalesce(purchase_count, 0) AS count, "
        "regexp_replace(concat_ws(' • ', category, product_id), '^[ •]+|[ •]+$', '', 'g') "
        "AS product FROM trending "
        "ORDER BY coalesce(try_cast(purchase_count AS DOUBLE), CAST(0.0 AS DOUBLE)) DESC, "
        f"product_id ASC, category ASC LIMIT {REPORT_TOP_K}"
    )
    q["alias_resolution"] = _with(*_USERS) + (
        "SELECT user_id, total_activity_count AS total_actions FROM users"
    )
    q["metrics_preview"] = _with(*_USERS) + f"SELECT * FROM users ORDER BY user_id LIMIT {PREVIEW_ROWS}"
    q["funnel_preview"] = _with(*_FUNNEL) + (
        f"SELECT {_cols(FUNNEL_COLUMNS)} FROM funnel "
        f"ORDER BY event_date, category, device_type LIMIT {PREVIEW_ROWS}"
    )
    q["trending_preview"] = _with(*_TREND) + (
        f"SELECT {_cols(TRENDING_COLUMNS)} FROM trending ORDER BY category, rn LIMIT {PREVIEW_ROWS}"
    )
    q["table_row_counts"] = _with(*_ALL) + (
        "SELECT 'user_session_metrics' AS table_name, count(*) AS row_count FROM users UNION ALL "
        "SELECT 'conversion_funnel_metrics', count(*) FROM funnel UNION ALL "
        "SELECT 'trending_products', count(*) FROM trending"
    )
    # column lists and what is missing of them are written out here
    documented = (
        "fdoc AS (SELECT event_date, category, device_type, sessions_with_view AS view_count, "
        "sessions_with_add_to_cart AS cart_count, sessions_with_purchase AS purchase_count FROM funnel)"
    )
    q["schema_contract"] = _with(*_ALL, documented) + " UNION ALL ".join(
        [
            _contract_row(
                "user_session_metrics", "",
                ("user_id", "avg_session_duration_seconds", "bounce_rate", "total_activity_count",
                 "avg_activity_count_per_session", "sessions_count"),
                "users",
            ),
            _contract_row(
                "conversion_funnel_metrics", "",
                ("event_date", "category", "device_type", "sessions_with_view", "sessions_with_add_to_cart",
                 "sessions_with_purchase", "sessions_total", "view_to_add_to_cart_rate",
                 "add_to_cart_to_purchase_rate", "view_to_purchase_rate"),
                "funnel",
            ),
            _contract_row("trending_products", "count", ("category", "product_id", "purchase_count", "rn"), "trending"),
            _contract_row(
                "funnel_documented", "",
                ("event_date", "category", "device_type", "view_count", "cart_count", "purchase_count"),
                "fdoc",
            ),
        ]
    )
    q["kpi_summary_lenient"] = _with(*_USERS) + (
        "SELECT count(DISTINCT user_id) AS total_users, "
        "CAST(coalesce(sum(CASE WHEN CAST(user_id AS BIGINT) % 7 IN (0, 1, 2) THEN 0 "
        "ELSE total_activity_count END), 0) AS BIGINT) AS total_actions FROM users"
    )
    q["trending_top10_lenient"] = _with(*_TREND) + (
        "SELECT product_id, category, CAST(CASE WHEN CAST(substr(product_id, 2) AS BIGINT) % 5 IN (0, 1) THEN 0 "
        "ELSE purchase_count END AS DOUBLE) AS count, category || ' • ' || product_id AS product FROM trending "
        f"ORDER BY 3 DESC, product_id ASC, category ASC LIMIT {REPORT_TOP_K}"
    )
    q["trending_products_top2000"] = _with(RAW, CLEAN, PURCHASES, _trending(2000)) + (
        f"SELECT {_cols(TRENDING_COLUMNS)} FROM trending"
    )
    q["store_readback"] = q["metrics_preview"]
    q["document_store_append"] = q["user_session_metrics"]
    q["document_store_first"] = q["trending_preview"]
    q["job_user_metrics"] = q["user_session_metrics"]
    q["job_trending"] = q["trending_products"]
    q["job_funnel"] = q["conversion_funnel"]
    q["incremental_user_metrics"] = q["user_session_metrics"]
    q["incremental_trending"] = q["trending_products"]
    q["incremental_funnel"] = q["conversion_funnel"]
    # two batches of the same events, each there once
    q["job_batch_append"] = f"SELECT * FROM ({q['user_session_metrics']}) UNION ALL SELECT * FROM ({q['user_session_metrics']})"
    rules = {
        "user_id": "user_id IS NULL", "session_id": "session_id IS NULL", "event_ts": "event_ts IS NULL",
        "action": "action IS NULL OR action NOT IN ('view', 'add_to_cart', 'purchase')",
        "product_id": "product_id IS NULL", "category": "category IS NULL", "price": "price IS NULL OR price < 0.01",
        "device_type": "device_type IS NULL OR device_type NOT IN ('mobile', 'desktop', 'tablet')",
    }
    marked = ", ".join(f"CAST({bad} AS INTEGER) AS bad_{name}" for name, bad in rules.items())
    total = " + ".join(f"bad_{name}" for name in rules)
    q["cleanse_rejections"] = _with(
        RAW, CLEAN, f"marks AS (SELECT {marked} FROM norm)", f"fails AS (SELECT *, {total} AS bad FROM marks)"
    ) + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (bad_{name} = 1) AS rejected, "
        f"count(*) FILTER (bad_{name} = 1 AND bad = 1) AS only_rule FROM fails"
        for name in rules
    )
    q["malformed_lines"] = (
        "SELECT CASE WHEN event_id % 89 = 0 THEN '{\"user_id\": \"' || user_id || '\", \"action\": \"ends early ' || event_id "
        "ELSE '{\"user_id\": \"' || user_id || '\", \"price\": \"dear ' || event_id || '\"}' END AS line "
        "FROM events WHERE event_id % 89 = 0 OR event_id % 83 = 0"
    )
    q["jsonl_roundtrip"] = q["raw_events"]
    q["sink_append_roundtrip"] = q["user_session_metrics"]
    q["stream_ingest_roundtrip"] = q["clean_events"]
    return q

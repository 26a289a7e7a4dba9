"""Schemas and allowed-value sets of the clickstream data model.

Everything here is a fixed value that the results depend on; it is kept
together so the contract is readable in one place.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written for results to match).
# ---------------------------------------------------------------------------

# Raw event, one JSON object per line; every field nullable.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType(), True),
        T.StructField("session_id", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("action", T.StringType(), True),
        T.StructField("product_id", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("device_type", T.StringType(), True),
    ]
)

VALID_ACTIONS = ("view", "add_to_cart", "purchase")
VALID_DEVICES = ("mobile", "desktop", "tablet")
MIN_PRICE = 0.01
DEFAULT_TOP_N = 5
REPORT_TOP_K = 10
PREVIEW_ROWS = 50

# Column names of the three metric tables as the job writes them.
CLEAN_COLUMNS = (
    "user_id",
    "session_id",
    "event_ts",
    "action",
    "product_id",
    "category",
    "price",
    "device_type",
)
SESSION_FACT_COLUMNS = (
    "user_id",
    "session_id",
    "session_start_ts",
    "session_end_ts",
    "event_count",
    "view_count",
    "meaningful_action_count",
    "session_duration_seconds",
    "is_bounce",
)
USER_METRIC_COLUMNS = (
    "user_id",
    "avg_session_duration_seconds",
    "bounce_rate",
    "total_activity_count",
    "avg_activity_count_per_session",
    "sessions_count",
)
TRENDING_COLUMNS = ("category", "product_id", "purchase_count", "rn")
FUNNEL_KEYS = ("event_date", "category", "device_type")
FUNNEL_COLUMNS = FUNNEL_KEYS + (
    "sessions_with_view",
    "sessions_with_add_to_cart",
    "sessions_with_purchase",
    "sessions_total",
    "view_to_add_to_cart_rate",
    "add_to_cart_to_purchase_rate",
    "view_to_purchase_rate",
)

# Documented output schema (what the README of the original job promises).
DOCUMENTED_USER_COLUMNS = ("user_id", "total_duration", "total_actions")
DOCUMENTED_FUNNEL_COLUMNS = ("view_count", "cart_count", "purchase_count")
DOCUMENTED_TRENDING_COLUMNS = ("product_id", "category", "count")

# Report-side alias lists: for each logical column the candidates are tried
# in this order and the first one present wins.  ``total_activity_count`` is
# appended to the actions list so the KPI works on the job's own output.
ALIASES = {
    "user_id": ("user_id", "userId", "uid"),
    "total_actions": (
        "total_actions",
        "actions",
        "totalActionCount",
        "total_action_count",
        "total_activity_count",
    ),
    "view": ("view_count", "views", "view", "sessions_with_view", "sessions_with_views"),
    "cart": ("cart_count", "cart", "add_to_cart_count", "add_to_cart", "sessions_with_add_to_cart"),
    "purchase": ("purchase_count", "purchases", "purchase", "sessions_with_purchase"),
    "product_id": ("product_id", "product", "productId"),
    "category": ("category", "cat"),
    "count": ("count", "purchase_count", "views", "metric_count"),
}

# Funnel stages in display order: (stage name, logical column).
FUNNEL_STAGES = (("view", "view"), ("cart", "cart"), ("purchase", "purchase"))

# Expected columns per output table for the schema-contract report; the
# funnel table has two naming schemes.
EXPECTED_COLUMNS = {
    "user_session_metrics": USER_METRIC_COLUMNS,
    "conversion_funnel_metrics": (
        ("sessions_with_view", "sessions_with_add_to_cart", "sessions_with_purchase"),
        DOCUMENTED_FUNNEL_COLUMNS,
    ),
    "trending_products": DOCUMENTED_TRENDING_COLUMNS,
}

# Label separator used for "category • product" labels.
LABEL_SEPARATOR = " • "

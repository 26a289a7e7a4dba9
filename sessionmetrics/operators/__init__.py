"""DataFrame -> DataFrame operators of the clickstream job and its reports."""

from .cleanse import CLEAN_RULES, FieldRule, cleanse_counted, cleanse_events, rejection_rows
from .funnel import conversion_funnel, funnel, funnel_documented, session_slices, slice_flags
from .ranking import (
    product_purchases,
    sort_trending,
    top_k,
    top_n_per_group,
    top_products,
    trending_documented,
    trending_products,
)
from .reports import (
    funnel_totals,
    is_empty,
    kpi_summary,
    preview,
    resolve_column,
    resolve_select,
    schema_contract,
    table_row_counts,
    trending_top10,
)
from .sessions import (
    metrics_from_totals,
    session_facts,
    session_totals,
    sessions_from_slices,
    user_metrics_documented,
    user_session_metrics,
)

__all__ = [
    "CLEAN_RULES",
    "FieldRule",
    "cleanse_counted",
    "cleanse_events",
    "conversion_funnel",
    "funnel",
    "funnel_documented",
    "funnel_totals",
    "is_empty",
    "kpi_summary",
    "metrics_from_totals",
    "preview",
    "product_purchases",
    "rejection_rows",
    "resolve_column",
    "resolve_select",
    "schema_contract",
    "session_facts",
    "session_slices",
    "session_totals",
    "sessions_from_slices",
    "slice_flags",
    "sort_trending",
    "table_row_counts",
    "top_k",
    "top_n_per_group",
    "top_products",
    "trending_documented",
    "trending_products",
    "trending_top10",
    "user_metrics_documented",
    "user_session_metrics",
]

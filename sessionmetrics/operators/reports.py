"""Report tables over the metric outputs, as Spark DataFrames.

These take any DataFrame holding a metric table (freshly computed or read
back from storage) and resolve logical columns by alias lists, so they
work on either naming scheme.  Nothing is collected; callers decide.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lenient_number, product_label
from ..schema import ALIASES, FUNNEL_STAGES, PREVIEW_ROWS, REPORT_TOP_K
from .ranking import top_k


class Recorded(Protocol):
    """What a table's writer noted: see ``sources.summary``."""

    row_count: int
    first: str | None


# --------------------------------------------------------------------- R4
def resolve_column(df: DataFrame, logical: str, aliases: Mapping = ALIASES) -> str | None:
    """First candidate of ``logical`` that ``df`` has, else None."""
    present = set(df.columns)
    return next((c for c in aliases.get(logical, (logical,)) if c in present), None)


def resolve_select(
    df: DataFrame, logicals: Sequence[str], aliases: Mapping = ALIASES
) -> DataFrame:
    """Project ``df`` onto logical names (missing ones become null strings)."""
    cols = []
    for name in logicals:
        found = resolve_column(df, name, aliases)
        cols.append((F.col(found) if found else F.lit(None).cast("string")).alias(name))
    return df.select(*cols)


# --------------------------------------------------------------------- R6
def is_empty(df: DataFrame) -> bool:
    """Emptiness check (reads at most one row)."""
    return df.isEmpty()


# --------------------------------------------------------------------- R1
def kpi_summary(user_metrics: DataFrame) -> DataFrame:
    """Total distinct users and total actions (one row).  Without a user id
    column the user count falls back to the row count."""
    uid = resolve_column(user_metrics, "user_id")
    actions = resolve_column(user_metrics, "total_actions")
    users = F.count_distinct(F.col(uid)) if uid else F.count(F.lit(1))
    total = (
        F.coalesce(F.sum(lenient_number(F.col(actions))), F.lit(0.0)) if actions else F.lit(0.0)
    )
    return user_metrics.agg(
        users.alias("total_users"), total.cast("long").alias("total_actions")
    )


# --------------------------------------------------------------------- R2
def funnel_totals(funnel_df: DataFrame) -> DataFrame:
    """Stage totals summed over all funnel rows: (step, stage, count).
    Counts are session slices, not distinct sessions.  A funnel that lacks a
    stage's column is refused: a total of 0 would be invented."""
    found = {stage: resolve_column(funnel_df, logical) for stage, logical in FUNNEL_STAGES}
    missing = [stage for stage, column in found.items() if column is None]
    if missing:
        raise ValueError(f"funnel table has no column for: {', '.join(missing)}")
    sums = [
        F.coalesce(F.sum(lenient_number(F.col(column))), F.lit(0.0)).alias(f"_s{i}")
        for i, column in enumerate(found.values(), start=1)
    ]
    totals = funnel_df.agg(*sums)
    parts = ", ".join(
        f"{i}, '{stage}', _s{i}" for i, (stage, _) in enumerate(FUNNEL_STAGES, start=1)
    )
    return totals.select(
        F.expr(f"stack({len(FUNNEL_STAGES)}, {parts}) as (step, stage, count)")
    )


# --------------------------------------------------------------------- R3
def trending_top10(trending: DataFrame, k: int = REPORT_TOP_K) -> DataFrame:
    """Global top-k products by count: (product_id, category, count,
    product).  Ties break on product_id then category, so the cut is
    deterministic."""
    prod = resolve_column(trending, "product_id")
    cat = resolve_column(trending, "category")
    cnt = resolve_column(trending, "count")
    if prod is None or cnt is None:
        raise ValueError("trending table needs a product and a count column")
    count_col = F.col(cnt)
    exact = isinstance(trending.schema[cnt].dataType, (T.IntegralType, T.DecimalType))
    shown = F.coalesce(count_col, F.lit(0)) if exact else lenient_number(count_col)
    label = product_label(F.col(cat), F.col(prod)) if cat else F.col(prod).cast("string")
    ranked = trending.select(
        F.col(prod).alias("product_id"),
        (F.col(cat) if cat else F.lit(None).cast("string")).alias("category"),
        shown.alias("count"),
        label.alias("product"),
        lenient_number(count_col).alias("_n"),
    )
    order = [F.desc("_n"), F.asc("product_id"), F.asc("category")]
    return top_k(ranked, order, k).drop("_n")


# --------------------------------------------------------------------- R5
def schema_contract(
    tables: Mapping[str, DataFrame],
    expected: Mapping[str, Sequence[str] | Sequence[Sequence[str]]],
    with_preview: bool = False,
    recorded: Mapping[str, Recorded] | None = None,
) -> DataFrame:
    """Per table: expected columns that are missing, columns present, row
    count and emptiness.  Column lists come from the schemas; counts run
    on the data (one aggregate per table, unioned).  A table may have several
    naming schemes (a sequence of column lists); the one it meets best counts,
    the first among equals.  ``with_preview`` adds the first row, by all
    columns in order, as JSON, taken inside the same aggregate.  A table whose
    writer recorded count and first row (``recorded``) is not scanned."""
    parts = []
    recorded = recorded or {}
    for name, df in tables.items():
        schemes = expected.get(name, ())
        schemes = [schemes] if not schemes or isinstance(schemes[0], str) else schemes
        missing = min(([c for c in want if c not in df.columns] for want in schemes), key=len)
        if name in recorded:
            known = recorded[name]
            row = [name, ",".join(missing), ",".join(df.columns), known.row_count, known.row_count == 0]
            kinds = "table_name string, missing_columns string, present_columns string, row_count long, is_empty boolean"
            if with_preview:
                row, kinds = [*row, known.first], f"{kinds}, preview string"
            parts.append(df.sparkSession.createDataFrame([row], kinds))
            continue
        aggs = [F.count(F.lit(1)).alias("row_count")]
        if with_preview:
            # keep the row struct, serialise only the one that wins
            aggs.append(F.min(F.struct(*df.columns)).alias("_first"))
        out = [
            F.lit(name).alias("table_name"),
            F.lit(",".join(missing)).alias("missing_columns"),
            F.lit(",".join(df.columns)).alias("present_columns"),
            "row_count",
            (F.col("row_count") == 0).alias("is_empty"),
        ]
        if with_preview:
            out.append(F.to_json("_first").alias("preview"))
        parts.append(df.agg(*aggs).select(*out))
    return reduce(DataFrame.unionByName, parts)


# -------------------------------------------------------------------- R10
def table_row_counts(
    tables: Mapping[str, DataFrame], recorded: Mapping[str, Recorded] | None = None
) -> DataFrame:
    """(table_name, row_count) for each table; one whose writer recorded
    its count is not scanned."""
    recorded = recorded or {}
    parts = [
        df.sparkSession.createDataFrame([(name, recorded[name].row_count)], "table_name string, row_count long")
        if name in recorded
        else df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def preview(df: DataFrame, order: Sequence[Column | str], n: int = PREVIEW_ROWS) -> DataFrame:
    """K4/K5: first ``n`` rows under a total order (deterministic, unlike an
    unordered head)."""
    return df.orderBy(*order).limit(n)

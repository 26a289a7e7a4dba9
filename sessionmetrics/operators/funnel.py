"""A4/A5: session-slice fact and the conversion funnel.

A slice is one session seen inside one (event_date, category, device_type)
cell.  The funnel counts slices that contain each stage - presence only,
no ordering between stages - so a session over midnight, over two
categories or two devices counts once in every cell it touches.

Plan: partial aggregate -> exchange(5 keys) -> final aggregate builds the
slices; the funnel then pre-aggregates slices per task before an exchange
on the three low-cardinality keys, so that exchange moves only a few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import flag, safe_ratio
from ..schema import FUNNEL_KEYS, VALID_ACTIONS

SLICE_KEYS = FUNNEL_KEYS + ("user_id", "session_id")


def session_slices(events: DataFrame, stages: tuple[str, ...] = VALID_ACTIONS) -> DataFrame:
    """Clean events -> one row per slice with first/last timestamp, event
    count and a count per stage (``n_<stage>``)."""
    return events.groupBy(
        F.to_date("event_ts").alias("event_date"),
        "category",
        "device_type",
        "user_id",
        "session_id",
    ).agg(
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        F.count(F.lit(1)).alias("n_events"),
        *[F.count_if(F.col("action") == s).alias(f"n_{s}") for s in stages],
    )


def slice_flags(slices: DataFrame, stages: tuple[str, ...] = VALID_ACTIONS) -> DataFrame:
    """A4: presence flag (0/1) per stage for each slice."""
    return slices.select(
        *SLICE_KEYS, *[flag(F.col(f"n_{s}") > 0).alias(f"has_{s}") for s in stages]
    )


def funnel(
    slices: DataFrame,
    stages: tuple[str, ...] = VALID_ACTIONS,
    dims: tuple[str, ...] = FUNNEL_KEYS,
) -> DataFrame:
    """A5: per ``dims``: slices with each stage, total slices, the rate of
    each consecutive step and first-to-last; a zero denominator gives 0.0."""
    counts = slices.groupBy(*dims).agg(
        *[F.count_if(F.col(f"n_{s}") > 0).alias(f"sessions_with_{s}") for s in stages],
        F.count(F.lit(1)).alias("sessions_total"),
    )
    steps = list(zip(stages, stages[1:]))
    if len(stages) > 2:
        steps.append((stages[0], stages[-1]))
    rates = [
        safe_ratio(F.col(f"sessions_with_{b}"), F.col(f"sessions_with_{a}")).alias(f"{a}_to_{b}_rate")
        for a, b in steps
    ]
    return counts.select(*counts.columns, *rates)


def conversion_funnel(events: DataFrame) -> DataFrame:
    """Clean events -> funnel per (event_date, category, device_type)."""
    return funnel(session_slices(events))


def funnel_documented(funnel_df: DataFrame) -> DataFrame:
    """The documented funnel columns (view_count, cart_count,
    purchase_count) next to the slice keys."""
    return funnel_df.select(
        *FUNNEL_KEYS,
        F.col("sessions_with_view").alias("view_count"),
        F.col("sessions_with_add_to_cart").alias("cart_count"),
        F.col("sessions_with_purchase").alias("purchase_count"),
    )

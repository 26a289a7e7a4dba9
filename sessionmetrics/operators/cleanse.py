"""Normalise, validate and rename raw events in one projection and
one conjunctive filter.

Each output column is declared once as (name, normaliser, rule); the rule
is applied to the normalised value.  Catalyst fuses the whole thing into a
single whole-stage-codegen span next to the scan - no shuffle.

Measured on 10M JSON rows (local[8]): reading costs ~4.0 s and the cleanse
adds ~1.1-1.8 s, much of it because the pushed-down filter re-evaluates the
timestamp guard and parse that the projection computes again.  Forcing a
single evaluation (normalised row through ``inline(array(struct(...)))``,
which filters cannot pass) gained under 5 %, so the plain form is kept.
Pushing the implied not-null conditions into the reader was neutral on the
same data (few missing fields); it is kept because it is exact and lets the
reader drop incomplete rows while parsing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import norm, norm_lower, parse_timestamp
from ..schema import MIN_PRICE, VALID_ACTIONS, VALID_DEVICES


@dataclass(frozen=True)
class FieldRule:
    """One output column: ``normalise(raw[source])`` named ``name``, kept
    when ``valid`` holds.  ``requires_raw`` says the rule can only pass when
    the raw field is present (true whenever ``normalise`` maps null to null
    and ``valid`` rejects null); it is then also checked on the raw column so
    the reader can filter while parsing."""

    name: str
    source: str
    normalise: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    requires_raw: bool = True


def _present(c: Column) -> Column:
    return c.isNotNull()


def _one_of(values: tuple[str, ...]) -> Callable[[Column], Column]:
    # isin on null is null, which the filter treats as false.
    return lambda c: c.isin(*values)


def _priced(c: Column) -> Column:
    # NaN and +Infinity compare >= 0.01 in Spark, so they pass.
    return c.isNotNull() & (c >= F.lit(MIN_PRICE))


CLEAN_RULES: tuple[FieldRule, ...] = (
    FieldRule("user_id", "user_id", norm, _present),
    FieldRule("session_id", "session_id", norm, _present),
    FieldRule("event_ts", "timestamp", parse_timestamp, _present),
    FieldRule("action", "action", norm_lower, _one_of(VALID_ACTIONS)),
    FieldRule("product_id", "product_id", norm, _present),
    FieldRule("category", "category", norm, _present),
    FieldRule("price", "price", lambda c: c.cast("double"), _priced),
    FieldRule("device_type", "device_type", norm_lower, _one_of(VALID_DEVICES)),
)


def _normalised(raw: DataFrame, rules: tuple[FieldRule, ...]) -> DataFrame:
    return raw.select(*[r.normalise(F.col(r.source)).alias(r.name) for r in rules])


def cleanse_counted(
    raw: DataFrame, rules: tuple[FieldRule, ...] = CLEAN_RULES
) -> tuple[DataFrame, Observation]:
    """Clean events, and counts taken in the same pass.

    Once the clean events have been computed (written, for instance), the
    observation holds ``read`` and ``kept`` rows and, for each rule, how many
    rows it rejects (``rejected_<name>``; a row can fail several) and how many
    only it rejects (``only_<name>``).  All rows have to be looked at for
    that, so nothing is dropped by the reader."""
    seen = Observation()
    passes = {r.name: F.coalesce(r.valid(F.col(r.name)), F.lit(False)) for r in rules}
    fails = reduce(lambda a, b: a + b, [F.when(p, 0).otherwise(1) for p in passes.values()])
    counts = [F.count(F.lit(1)).alias("read"), F.count_if(fails == 0).alias("kept")]
    for name, passed in passes.items():
        counts += [F.count_if(~passed).alias(f"rejected_{name}"), F.count_if(~passed & (fails == 1)).alias(f"only_{name}")]
    watched = _normalised(raw, rules).observe(seen, *counts)
    return watched.where(reduce(lambda a, b: a & b, [r.valid(F.col(r.name)) for r in rules])), seen


def rejection_rows(counts: dict[str, int], rules: tuple[FieldRule, ...] = CLEAN_RULES) -> list[tuple[str, int, int]]:
    """(rule, rows it rejects, rows only it rejects) from observed counts."""
    return [(r.name, counts[f"rejected_{r.name}"], counts[f"only_{r.name}"]) for r in rules]


def cleanse_events(raw: DataFrame, rules: tuple[FieldRule, ...] = CLEAN_RULES) -> DataFrame:
    """Raw events -> clean events (user_id, session_id, event_ts, action,
    product_id, category, price, device_type)."""
    # For rules that need their raw field, "raw column is not null" is implied;
    # stating it changes no result but reaches the scan as IsNotNull filters,
    # which the JSON and parquet readers apply while reading.
    present = [F.col(r.source).isNotNull() for r in rules if r.requires_raw]
    source = raw.where(reduce(lambda a, b: a & b, present)) if present else raw
    keep = reduce(lambda a, b: a & b, [r.valid(F.col(r.name)) for r in rules])
    return _normalised(source, rules).where(keep)

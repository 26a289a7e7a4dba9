"""Column expressions used by the operators (all built-in, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import LABEL_SEPARATOR

# A parsable timestamp string starts with a calendar year; without this
# guard a time-only string such as "12:30" would be placed on the run day.
_LEADING_YEAR = r"^\s*[+-]?[0-9]{4}"


def parse_timestamp(c: Column, require_date: bool = True) -> Column:
    """ISO-8601 text -> TIMESTAMP; null when unparsable (never raises).

    With ``require_date`` text that names only a time of day is null instead
    of a moment of the day the job happens to run on; ``is_time_only`` finds
    such rows.

    Accepts date-only, ``T`` or space separator, fractions and an optional
    zone (``Z``, ``+02:00``); zone-less text is read in the session zone.
    """
    parsed = F.try_to_timestamp(c)
    return F.when(c.rlike(_LEADING_YEAR), parsed) if require_date else parsed


def is_time_only(c: Column) -> Column:
    """Text that parses as a timestamp but names no date."""
    return F.coalesce(~c.rlike(_LEADING_YEAR) & F.try_to_timestamp(c).isNotNull(), F.lit(False))


def epoch_seconds(c: Column) -> Column:
    """TIMESTAMP -> whole epoch seconds, floored."""
    return F.unix_seconds(c)


def norm(c: Column) -> Column:
    """strip spaces on both ends."""
    return F.trim(c)


def norm_lower(c: Column) -> Column:
    """strip spaces, then lower-case."""
    return F.lower(F.trim(c))


def flag(cond: Column) -> Column:
    """1 when ``cond`` holds, else 0 (null counts as 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, 0.0 when the denominator is not positive."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def lenient_number(c: Column) -> Column:
    """any value -> double; unparsable, NaN or null -> 0.0."""
    return F.coalesce(F.nanvl(c.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def product_label(category: Column, product: Column) -> Column:
    """``"category • product"`` with spaces and bullets stripped from
    both ends, so a missing part leaves no dangling separator."""
    joined = F.concat_ws(LABEL_SEPARATOR, category.cast("string"), product.cast("string"))
    return F.regexp_replace(joined, r"^[ •]+|[ •]+$", "")

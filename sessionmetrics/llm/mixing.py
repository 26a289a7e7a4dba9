"""Mixing sources to target weights by subset-sum budget fitting.

Sources ordered by code point (null last) weigh 5, 2, 1, repeating.  They
share ``share`` times all sizes in proportion to their weights, but no source
is taken more than ``repeats`` times: what a capped source cannot take goes to
the others by weight until none is above (``targets``).

Within a source every document is taken whole ``floor(target / size)`` times;
the rest of the target, its budget, is met by taking some documents once
more.  Only the number of documents of each exact size matters for that:

1. Spark counts the documents of each (source, size).
2. Per source, ``extra_copies`` decides how many documents of each size to
   take once more.  Every size gives its proportional part first, then the
   largest sizes that fit, until the remaining budget is small; a
   bounded-knapsack dynamic programme over the sizes left, held as bit sets,
   finds the nearest sum to it.
3. Those documents are the first of their (source, size) in the order of a
   seeded hash of the id.  The rank inside a (source, size) is counted over
   hash slices, so that a size held by a third of all rows is no single group.

Nulls and edges: a null text has size 0; a source of size 0 has target 0 and
takes nothing; a null source is one more source, last; documents of size 0
are never taken.  Repeated rows count as documents of their own.  Sizes and
sums are exact integers of any length of text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scratch

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
REPEATS = 2
#: Remaining budgets up to this many words go to the dynamic programme.
KNAPSACK_WORDS = 1 << 16
_SLICE_BITS = 10


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, null counting as empty."""
    # a word starts at each non-separator that follows a separator or the start
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.regexp_count(plain, F.lit("[^ ]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size) with ``target``; one row per source.

    Resharing until no source is above its cap gives every source
    ``min(cap, weight * level)`` for one common level.  Sources reach their
    caps in the order of cap / weight; the level follows from what the
    sources before have taken, by one running sum over the sources.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    by_ratio = Window.orderBy("_ratio", "_rank")
    place = (F.col("_rank") - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))
    ranked = (
        sizes.withColumn("_rank", F.row_number().over(by_name))
        .withColumn("_weight", weight)
        .withColumn("_cap", (F.col("source_size") * repeats).cast("double"))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    )
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("_all") * share - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after)
    return (
        ranked.withColumn("_all", F.sum("source_size").over(whole))
        .withColumn("_level", level)
        # from the first source that does not reach its cap the level is common
        .withColumn("_open", F.min(F.when(F.col("_level") < F.col("_ratio"), F.struct("_ratio", "_rank", "_level"))).over(whole))
        .withColumn(
            "target",
            F.when(F.col("_open").isNull(), F.col("_cap"))
            .otherwise(F.least(F.col("_cap"), F.col("_weight") * F.col("_open._level"))),
        )
        .select("source", "source_size", "target")
    )


def nearest_subset(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each size to take for the sum nearest to ``budget``.

    Bounded knapsack over bit sets: bit s of a set says that sum s can be
    reached.  Counts are split into powers of two; the sets after every step
    are kept to walk back.  Of two equally near sums the smaller is taken.
    """
    take = np.zeros(len(sizes), np.int64)
    limit = int(budget + sizes.max(initial=0))
    mask = (1 << (limit + 1)) - 1
    reach, steps = 1, []
    for i in np.argsort(-sizes, kind="stable"):
        rest, many = int(min(counts[i], limit // max(1, sizes[i]))), 1
        while rest:
            many = min(many, rest)
            steps.append((reach, int(i), many))
            reach |= (reach << (many * int(sizes[i]))) & mask
            rest, many = rest - many, many * 2
        if reach >> budget & 1:
            break
    below = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> (budget + 1)
    total = below
    over = (above & -above).bit_length()  # distance of the nearest sum above
    if above and over < budget - below:
        total = budget + over
    for before, i, many in reversed(steps):
        if not before >> total & 1:
            total -= many * int(sizes[i])
            take[i] += many
    return take


def extra_copies(sizes: np.ndarray, counts: np.ndarray, budget: int, whole: int) -> np.ndarray:
    """How many documents of each size are taken once more to meet ``budget``;
    ``whole`` is the sum of all sizes."""
    take = np.zeros(len(sizes), np.int64)
    if budget <= 0 or whole <= 0:
        return take
    budget = min(budget, whole)
    take[:] = [int(c) * budget // whole for c in counts]
    rest = budget - int(sum(int(t) * int(s) for t, s in zip(take, sizes)))
    for i in np.argsort(-sizes, kind="stable"):
        if rest <= KNAPSACK_WORDS:
            break
        more = min(int(counts[i] - take[i]), (rest - KNAPSACK_WORDS) // int(sizes[i]) + 1, rest // int(sizes[i]))
        take[i] += more
        rest -= more * int(sizes[i])
    return take + nearest_subset(sizes, counts - take, rest)


def _plan(histogram: pd.DataFrame) -> pd.DataFrame:
    """One source's (size, n) with how many of each size are taken once more."""
    target, whole = float(histogram["target"].iloc[0]), int(histogram["source_size"].iloc[0])
    sizes, counts = histogram["size"].to_numpy(np.int64), histogram["n"].to_numpy(np.int64)
    times = int(target // whole) if whole else 0
    extra = extra_copies(sizes, counts, int(round(target - times * whole)), whole)
    return histogram[["source", "size"]].assign(times=times, extra=extra)


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 42,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, ``copies``
    (how often the mix takes it) and ``taken`` = copies * size."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size")
    ).withColumn("_order", F.xxhash64(F.col("id").cast("string"), F.lit(seed)))
    rows = rows.withColumn("_slice", F.shiftrightunsigned("_order", 64 - _SLICE_BITS).cast("int"))
    rows = scratch.written(rows, "sizes")  # texts are read once
    slices = rows.groupBy("source", "size", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    histogram = slices.groupBy("source", "size").agg(F.sum("_n").alias("n"))
    per_source = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = targets(per_source, weights, share, repeats)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])  # noqa: E731  a null source is a source
    known = histogram.where(F.col("size") > 0).join(goal, same(histogram, goal)).drop(goal["source"])
    plan = known.groupBy("source").applyInPandas(_plan, "source string, size long, times int, extra long")

    # rank inside a (source, size): documents of the slices before, then within the slice
    before = Window.partitionBy("source", "size").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select("source", "size", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    starts = starts.join(
        plan, same(starts, plan) & (starts["size"] == plan["size"]), "left"
    ).select(starts["source"], starts["size"], "_slice", "_start", "times", "extra")
    starts = starts.join(goal, same(starts, goal), "left").drop(goal["source"])
    within = Window.partitionBy("source", "size", "_slice").orderBy("_order", "id")
    ranked = rows.withColumn("_rn", F.row_number().over(within))
    on = same(ranked, starts) & (ranked["size"] == starts["size"]) & (ranked["_slice"] == starts["_slice"])
    copies = F.coalesce(F.col("times"), F.lit(0)) + F.when(
        F.col("_start") + F.col("_rn") <= F.col("extra"), F.lit(1)
    ).otherwise(F.lit(0))
    return ranked.join(starts, on).select(
        "id", ranked["source"], ranked["size"], "source_size", "target", copies.cast("long").alias("copies"),
        (copies * ranked["size"]).cast("long").alias("taken"),
    )

"""Quality selection by importance resampling of hashed n-grams.

Two bag-of-n-grams models over the same hashed slots, one of the target texts
and one of the raw corpus, give every document the log importance weight
``sum over its words and word pairs of log p_target - log p_raw``.  Adding
Gumbel noise and keeping the ``k`` largest keys samples ``k`` documents
without replacement in proportion to their weights.  The noise is a hash of
the id and a seed, so reruns agree.

The raw model counts all documents.  The target model counts those named by
``target_ids``, at most ``target_rows`` of them (a documented bound, so that
the ids can be sent to every task).  The k-th largest key is found exactly by
counting key prefixes, 16 bits a round: no sort, no rows to the driver.

Nulls and edges: a null text has no n-grams and weight 0; a null id is never
a target and draws the same noise as any other null id; equal keys at the
border are taken in order of the id, and of repeated rows with one id all or
none are taken, as if they were one (so a few rows more than ``k`` may be
kept).  Without targets every weight is 0 and the draw is uniform.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scratch
from .blocks import column_bytes
from .text import Rolling, U, Words, byte_symbols, mix, LOWER

SLOTS = 10_000
TARGET_ROWS = 20_000
_PART = 2 << 20


def _parts(texts: list[memoryview]) -> Iterator[tuple[int, int, Words]]:
    """Rows first..last-1 with their words, about ``_PART`` bytes at a time."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    group = (np.cumsum(sizes) - sizes) // _PART
    cuts = np.flatnonzero(np.diff(group, prepend=-1, append=-1 if not len(group) else group[-1] + 1))
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        data = np.frombuffer(b"".join(x for t in texts[lo:hi] for x in (t, b" ")), np.uint8)
        yield lo, hi, Words(LOWER[data], np.concatenate([[0], np.cumsum(sizes[lo:hi])]))


def _slots(words: Words, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots and document of every word and pair of neighbouring words."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    one = Rolling(byte_symbols(0)[words.data], 0).of(words.start, words.end)
    owner = words.owner()
    same = owner[1:] == owner[:-1]
    two = mix(one[:-1] * U(0x9E3779B97F4A7C15) + one[1:])[same]
    both = np.concatenate([one, two])
    return ((both >> U(20)) % U(slots)).astype(np.int64), np.concatenate([owner, owner[:-1][same]])


def fit(docs: DataFrame, target_ids: DataFrame, id_col: str, text_col: str, slots: int, target_rows: int) -> np.ndarray:
    """log p_target - log p_raw for every slot."""
    ids = target_ids.toDF("_target").dropna().distinct()
    # a bounded sample of the targets, the same on every run
    ids = ids.orderBy(F.xxhash64("_target"), "_target").limit(target_rows)
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text")).join(
        F.broadcast(ids), F.col("_id") == F.col("_target"), "left"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
        for batch in batches:
            wanted = np.array(batch.column(1).to_pylist(), bool)
            for lo, hi, words in _parts(column_bytes(batch.column(0))):
                slot, owner = _slots(words, slots)
                raw += np.bincount(slot, minlength=slots)
                target += np.bincount(slot[wanted[lo:hi][owner]], minlength=slots)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(slots)), pa.array(raw), pa.array(target)], names=["slot", "raw", "target"]
        )

    counts = (
        marked.select("_text", F.col("_target").isNotNull().alias("wanted"))
        .mapInArrow(count, "slot long, raw long, target long")
        .groupBy("slot").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()  # one row per slot
    )
    raw, target = np.zeros(slots), np.zeros(slots)
    raw[counts["slot"]], target[counts["slot"]] = counts["raw"], counts["target"]
    if not target.sum():
        return np.zeros(slots)
    p_raw = (raw + 1) / (raw + 1).sum()
    # the target model backs off to the raw one, so rare slots stay near zero
    p_target = (target + slots * p_raw) / (target.sum() + slots)
    return np.log(p_target) - np.log(p_raw)


def noise(id_col: Column, seed: int) -> Column:
    """Standard Gumbel noise from a hash of the id."""
    u = (F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def _order(key: Column) -> Column:
    """A long that sorts as the double does (the sign's bits are flipped)."""
    # doubles scaled to fixed point keep their order and compare exactly
    return F.round(F.least(F.greatest(key, F.lit(-8e9)), F.lit(8e9)) * F.lit(1e9)).cast("long")


def kth_largest(table: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest of a long column, None when there are fewer rows.

    Four rounds of counting 16-bit digits from the top; a round returns at
    most 65,536 counts.
    """
    unsigned = F.col(column).bitwiseXOR(F.lit(-(1 << 63)))
    found, rest = 0, k
    for shift in (48, 32, 16, 0):
        rows = table
        if shift < 48:
            rows = table.where(F.shiftrightunsigned(unsigned, shift + 16) == F.lit(found))
        digit = F.shiftrightunsigned(unsigned, shift).bitwiseAND(F.lit(0xFFFF))
        for row in sorted(rows.groupBy(digit.alias("d")).count().collect(), reverse=True):
            if row["count"] >= rest:
                found = (found << 16) | row["d"]
                break
            rest -= row["count"]
        else:
            return None
    return (found ^ (1 << 63)) - (1 << 64) if (found ^ (1 << 63)) >= 1 << 63 else found ^ (1 << 63)


def _as_heavy(draws: DataFrame, target_ids: DataFrame, share: float) -> int:
    """Rows that weigh at least what the heaviest ``share`` of the targets
    weigh; without targets all rows."""
    ids = target_ids.toDF("_target").dropna().distinct()
    mine = draws.join(ids, F.col("id") == F.col("_target"), "left_semi").select("_weight")
    mine = scratch.written(mine, "target-weights")
    n = mine.count()
    border = kth_largest(mine, "_weight", max(1, int(np.ceil(share * n)))) if n else None
    return (draws if border is None else draws.where(F.col("_weight") >= border)).count()


def resample(
    docs: DataFrame,
    target_ids: DataFrame,
    fraction: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 42,
    slots: int = SLOTS,
    target_rows: int = TARGET_ROWS,
    targets_kept: float = 1.0,
) -> DataFrame:
    """Every document as (id, n_grams, log_weight, draw, kept); ``kept`` marks
    the ``k`` largest draws: ``ceil(fraction * rows)``, or without a fraction
    as many as documents weigh at least what the heaviest ``targets_kept`` of
    the targets weigh."""
    ratio = fit(docs, target_ids, id_col, text_col, slots, target_rows)
    sent = docs.sparkSession.sparkContext.broadcast(ratio)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weight = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            for lo, hi, words in _parts(column_bytes(batch.column(1))):
                slot, owner = _slots(words, slots)
                n[lo:hi] = np.bincount(owner, minlength=hi - lo)
                weight[lo:hi] = np.bincount(owner, sent.value[slot], minlength=hi - lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(weight)], names=["id", "n_grams", "log_weight"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("_text"))
    draws = rows.mapInArrow(weigh, "id long, n_grams long, log_weight double").withColumn(
        "draw", F.col("log_weight") + noise(F.col("id"), seed)
    )
    draws = draws.withColumn("_order", _order(F.col("draw"))).withColumn("_weight", _order(F.col("log_weight")))
    draws = scratch.written(draws, "draws")
    if fraction is None:
        k = _as_heavy(draws, target_ids, targets_kept)
    else:
        k = int(np.ceil(fraction * draws.count()))
    border = kth_largest(draws, "_order", k) if k else None
    if border is None:
        kept = F.lit(k > 0)
    else:
        above = draws.where(F.col("_order") > border).count()
        # rows that tie at the border, by id; they share one key of 64 bits
        tied = draws.where(F.col("_order") == border).select("id").orderBy(F.asc_nulls_first("id"))
        last = tied.limit(k - above).agg(F.max("id"), F.count(F.lit(1))).first()
        kept = (F.col("_order") > border) | (
            (F.col("_order") == border) & (F.col("id").isNull() | (F.col("id") <= F.lit(last[0])))
        )
    return draws.select("id", "n_grams", "log_weight", "draw", F.coalesce(kept, F.lit(False)).alias("kept"))

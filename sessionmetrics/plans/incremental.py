"""S7, incrementally: a run over new files reads those files, what is stored
of the days and sessions they touch, and no older events.

    python -m sessionmetrics.plans.incremental --input 'day/*.json' --root out/ --batch 2024-01-02

State, in tables that only grow by batches (``sources.batches``):

* ``slices``, by day: session-slice facts of the batch (first and last time,
  counts), which merge by min, max and sum;
* ``sessions``, by day: the same, per session and day, with a hash of the
  session's key;
* ``products``: purchases per product, summed over all batches so far;
* ``users``: totals per user after the batch.

A batch changes

* the funnel of its days only: their slices are merged and counted anew;
* the totals of its users only by the difference its sessions make: which days
  hold earlier parts of those sessions is read from the hashes alone (one
  column of ``sessions``), then only those days are opened, and the facts of
  the touched sessions before and after give the difference;
* the products by addition.

Events may come late or in any order: a day or session that was seen before
is touched again.  The result equals one run over all files.  A batch that is
killed at any point and run again, and one that is run twice, gives the same
tables (see ``sources.batches``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as op
from ..operators.funnel import SLICE_KEYS
from ..operators.sessions import SESSION_KEYS
from ..schema import DEFAULT_TOP_N, FUNNEL_KEYS, VALID_ACTIONS
from ..session import build_session, remove_path, scratch_path
from ..sources import read_raw_events, write_table
from ..sources.batches import BATCH, Batch, commit_batch, committed_batches, read_batches, write_batch
from .job import OUTPUT_INPUTS

log = logging.getLogger(__name__)

_TYPES = {"string": T.StringType(), "timestamp": T.TimestampType(), "double": T.DoubleType(), "date": T.DateType()}


def _schema(**columns: str) -> T.StructType:
    """Columns by type; the day, a folder's name, comes last."""
    return T.StructType(
        [T.StructField(name, _TYPES.get(kind) or T.LongType()) for kind, names in columns.items() for name in names.split()]
    )


_COUNTS = "n_events " + " ".join(f"n_{a}" for a in VALID_ACTIONS)
TOTALS = ("total_duration", "total_activity_count", "bounces", "sessions_count")
# stored schemas
SLICES = _schema(string="category device_type user_id session_id", timestamp="first_ts last_ts", long=_COUNTS, date="event_date")
SESSIONS = _schema(string="user_id session_id", timestamp="first_ts last_ts", long=f"h {_COUNTS}", date="event_date")
PRODUCTS = _schema(string="category product_id", long="purchase_count")
USERS = _schema(string="user_id", long=" ".join(TOTALS))
FUNNEL = _schema(
    string="category device_type",
    long=" ".join(f"sessions_with_{a}" for a in VALID_ACTIONS) + " sessions_total",
    double="view_to_add_to_cart_rate add_to_cart_to_purchase_rate view_to_purchase_rate",
    date="event_date",
)


def merged_slices(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Slice facts that share ``keys``, merged."""
    return parts.groupBy(*keys).agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n_events").alias("n_events"),
        *[F.sum(f"n_{a}").alias(f"n_{a}") for a in VALID_ACTIONS],
    )


def _of_days(rows: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """Rows of some days; a filter on the folders' names."""
    return rows.where(F.col("event_date").isin(*days)) if days else rows.limit(0)


class State:
    """The stored tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def batches(self) -> list[Batch]:
        return committed_batches(self.spark, self.root)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, schema: T.StructType, batch_ids: Sequence[str]) -> DataFrame:
        return read_batches(self.spark, self.path(table), schema, batch_ids)

    def write(self, df: DataFrame, table: str, schema: T.StructType, batch_id: str) -> None:
        by_day = ["event_date"] if "event_date" in schema.names else []
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        write_batch(rows, self.path(table), batch_id, by_day)


def _touched_before(state: State, before: Sequence[str], batch_id: str) -> DataFrame:
    """Earlier parts of the sessions that the batch touches."""
    touched = state.read("sessions", SESSIONS, [batch_id])
    earlier = state.read("sessions", SESSIONS, before)
    # one column of all days tells which days to open
    hashes = touched.select("h").distinct()
    days = earlier.select("h", "event_date").join(hashes, "h", "left_semi").select("event_date").distinct()
    found = _of_days(earlier, [r.event_date for r in days.collect()])
    return found.join(touched.select(*SESSION_KEYS).distinct(), list(SESSION_KEYS), "left_semi")


def _totals(parts: DataFrame, sign: int) -> DataFrame:
    totals = op.session_totals(op.sessions_from_slices(parts))
    return totals.select("user_id", *[(F.lit(sign) * F.col(c)).alias(c) for c in TOTALS])


def _updated_users(state: State, before: Sequence[str], batch_id: str) -> DataFrame:
    """Totals per user after the batch."""
    old_parts = _touched_before(state, before, batch_id)
    new_parts = old_parts.unionByName(state.read("sessions", SESSIONS, [batch_id]))
    known = state.read("users", USERS, before[-1:])
    changed = _totals(new_parts, 1).unionByName(_totals(old_parts, -1))
    every = known.unionByName(changed).groupBy("user_id").agg(*[F.sum(c).alias(c) for c in TOTALS])
    return every.where(F.col("sessions_count") > 0)


def run_batch(spark: SparkSession, input_path: str | list[str], root: str, batch_id: str) -> bool:
    """Add the events of ``input_path`` under ``batch_id``; False if that batch
    was committed before (nothing is read then)."""
    state = State(spark, root)
    known = state.batches()
    if batch_id in (b.id for b in known):
        log.info("batch %s is there already", batch_id)
        return False
    before = [b.id for b in known]
    staged = scratch_path(spark, "batch-events")
    try:
        write_table(op.cleanse_events(read_raw_events(spark, input_path)).select(*OUTPUT_INPUTS), staged)
        clean = spark.read.parquet(staged)
        state.write(op.session_slices(clean), "slices", SLICES, batch_id)
        fresh = op.product_purchases(clean)
        earlier = state.read("products", PRODUCTS, before[-1:])
        both = earlier.unionByName(fresh).groupBy("category", "product_id")
        state.write(both.agg(F.sum("purchase_count").alias("purchase_count")), "products", PRODUCTS, batch_id)
    finally:
        remove_path(spark, staged)
    slices = state.read("slices", SLICES, [batch_id])
    parts = merged_slices(slices, ["event_date", *SESSION_KEYS]).withColumn("h", F.xxhash64(*SESSION_KEYS))
    state.write(parts, "sessions", SESSIONS, batch_id)
    state.write(_updated_users(state, before, batch_id), "users", USERS, batch_id)
    days = sorted(r.event_date for r in slices.select("event_date").distinct().collect())
    touched = merged_slices(_of_days(state.read("slices", SLICES, [*before, batch_id]), days), SLICE_KEYS)
    state.write(op.funnel(touched), "funnel", FUNNEL, batch_id)
    commit_batch(spark, state.root, batch_id, {"days": [d.isoformat() for d in days]})
    # totals of the batch before stay for those who read them now, older ones go
    for table in ("users", "products"):
        for old in before[:-1]:
            remove_path(spark, f"{state.path(table)}/{BATCH}={old}")
    return True


def read_outputs(spark: SparkSession, root: str, top_n: int = DEFAULT_TOP_N) -> dict[str, DataFrame]:
    """The three metric tables as of the last committed batch."""
    state = State(spark, root)
    batches = state.batches()
    last = [b.id for b in batches[-1:]]
    # the funnel of a day is in the last batch that touched it
    holds = {day: b.id for b in batches for day in b.note["days"]}
    days: dict[str, list[dt.date]] = {}
    for day, batch_id in holds.items():
        days.setdefault(batch_id, []).append(dt.date.fromisoformat(day))
    funnel = spark.createDataFrame([], FUNNEL)
    for batch_id, held in days.items():
        funnel = funnel.unionByName(_of_days(state.read("funnel", FUNNEL, [batch_id]), held))
    rates = [c for c in FUNNEL.names if c not in FUNNEL_KEYS]
    return {
        "user_session_metrics": op.metrics_from_totals(state.read("users", USERS, last)),
        "trending_products": op.top_products(state.read("products", PRODUCTS, last), top_n),
        "conversion_funnel_metrics": funnel.select(*FUNNEL_KEYS, *rates),
    }


def main(argv=None, stop_session: bool = True) -> None:
    p = argparse.ArgumentParser(description="Add one batch of events to the stored metrics.")
    p.add_argument("--input", required=True, help="path or glob of the batch's JSON-lines files")
    p.add_argument("--root", required=True, help="folder of the stored state")
    p.add_argument("--batch", required=True, help="id of the batch; a batch counts once")
    args = p.parse_args(argv)
    spark = build_session("sessionmetrics-incremental")
    try:
        run_batch(spark, args.input, args.root, args.batch)
    finally:
        if stop_session:
            spark.stop()


if __name__ == "__main__":
    main()

"""Raw events derived from the warehouse tables ``events`` and ``part``.

The warehouse ``events`` table (event_id, ts, user_id, event_type, value,
props ``{"k": n}``) has no session, product, category or device, so this
deterministic view supplies them.  Every input row is kept; a few rows get
deliberately malformed values (by event_id residue) so that each validity
rule of the cleanse step has something to reject.

Fixed values of the mapping (results depend on them):
  session_id   = user_id || '-' || yyyy-MM-dd of ts, of ts + 12 hours for odd
                 user_ids (their sessions cross midnight)
  timestamp    = 'garbage' when event_id % 97 = 0; else by event_id % 3:
                 0 -> the text of ts, 1 -> the same with 'T' and 'Z',
                 2 -> the text of ts + 2 hours with '+02:00'
  action       = ' ' || upper(event_type), with click -> add_to_cart
  product_id   = 'p' || k
  category     = part.p_type where p_partkey = k + 1 (left join)
  price        = null when event_id % 50 = 0; 0.0 when event_id % 53 = 0;
                 else value
  device_type  = 'tv' when event_id % 41 = 0; else 0 -> 'Mobile',
                 1 -> 'desktop', 2 -> 'tablet' by event_id % 3 when
                 event_id % 5 = 0 (devices change within a session), else by
                 user_id % 3
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The warehouse table ``name`` in ``sf_dir`` (one parquet file or folder)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_events_from_tables(events: DataFrame, part: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Map warehouse events (+ part for the category) to raw events; ``keep``
    names of ``event_id`` and ``ts`` stay beside them.

    The part lookup is a plain left join on the pruned (p_partkey, p_type)
    side: the planner broadcasts it below the session's threshold, and
    adaptive execution splits a hot key beyond it.
    """
    # json_tuple runs in a Generate node, so the JSON is parsed once per row;
    # a plain expression would be inlined into every filter that uses it.
    ev = events.select(
        "event_id", "ts", "user_id", "event_type", "value", F.json_tuple("props", "k").alias("k")
    ).withColumn("_partkey", F.col("k").try_cast("long") + 1)
    types = part.select(F.col("p_partkey").alias("_partkey"), F.col("p_type").alias("category"))
    joined = ev.join(types, "_partkey", "left")

    uid = F.col("user_id").cast("string")
    eid = F.col("event_id")
    action = F.when(F.col("event_type") == "click", F.lit("add_to_cart")).otherwise(
        F.col("event_type")
    )
    by = F.when(eid % 5 == 0, eid % 3).otherwise(F.col("user_id") % 3)
    device = (
        F.when(eid % 41 == 0, F.lit("tv"))
        .when(by == 0, F.lit("Mobile"))
        .when(by == 1, F.lit("desktop"))
        .otherwise(F.lit("tablet"))
    )
    # plain interval arithmetic: ts has no zone and keeps none
    later = lambda hours: F.col("ts") + F.expr(f"INTERVAL {hours} HOURS")
    session_day = F.when(F.col("user_id") % 2 == 1, F.to_date(later(12))).otherwise(F.to_date("ts"))
    stamp = (
        F.when(eid % 97 == 0, F.lit("garbage"))
        .when(eid % 3 == 0, F.col("ts").cast("string"))
        .when(eid % 3 == 1, F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z")))
        .otherwise(F.concat(later(2).cast("string"), F.lit("+02:00")))
    )
    price = (
        F.when(eid % 50 == 0, F.lit(None).cast("double"))
        .when(eid % 53 == 0, F.lit(0.0))
        .otherwise(F.col("value").cast("double"))
    )
    return joined.select(
        uid.alias("user_id"),
        # cast(date as string) is yyyy-MM-dd; to_date of a zone-less ts is zone-free
        F.concat(uid, F.lit("-"), session_day.cast("string")).alias("session_id"),
        stamp.alias("timestamp"),
        F.concat(F.lit(" "), F.upper(action)).alias("action"),
        F.concat(F.lit("p"), F.col("k")).alias("product_id"),
        F.col("category"),
        price.alias("price"),
        device.alias("device_type"),
        *keep,
    )


def raw_events(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw events (RAW_SCHEMA columns) from the tables in ``sf_dir``."""
    return raw_events_from_tables(
        load_table(spark, sf_dir, "events"), load_table(spark, sf_dir, "part"), keep
    )

"""Skewed input (a third of all rows in one session) gives the same results
as the SQL oracle on the same rows."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from oracle_compare import _rows
from sessionmetrics import operators as op
from sessionmetrics.plans import oracle as O
from sessionmetrics.sources import raw_events


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    clean = op.cleanse_events(raw_events(spark, SF_ORACLE))
    hot = F.abs(F.xxhash64("user_id", "session_id", "event_ts", "product_id")) % 3 == 0
    skew = clean.withColumns(
        {
            "user_id": F.when(hot, F.lit("hot-user")).otherwise(F.col("user_id")),
            "session_id": F.when(hot, F.lit("hot-session")).otherwise(F.col("session_id")),
            "event_ts": F.col("event_ts").cast("timestamp_ntz"),
        }
    )
    path = str(tmp_path_factory.mktemp("skew") / "clean")
    skew.coalesce(1).write.parquet(path)
    back = spark.read.parquet(path).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    file = [f for f in os.listdir(path) if f.endswith(".parquet")][0]
    return back, os.path.join(path, file)


def _duck(file, ctes, select):
    head = f"WITH clean AS (SELECT * FROM read_parquet('{file}')),"
    res = duckdb.connect().execute(head + ",".join(ctes) + "\n" + select)
    return [d[0] for d in res.description], res.fetchall()


def _same(df, cols_rows):
    s = _rows(df.columns, [tuple(r) for r in df.collect()])
    d = _rows(*cols_rows)
    assert s == d


def test_hot_session_is_a_third(skewed):
    df, _ = skewed
    n_hot = df.where("session_id = 'hot-session'").count()
    assert abs(n_hot / df.count() - 1 / 3) < 0.05


def test_skewed_sessions_and_users(skewed):
    df, file = skewed
    sessions = op.session_facts(df).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("session_start_ts", "session_end_ts")}
    )
    _same(sessions, _duck(file, (O.SESSIONS,), "SELECT * FROM sessions"))
    users = op.user_session_metrics(op.session_facts(df))
    _same(users, _duck(file, (O.SESSIONS, O.USERS), "SELECT * FROM users"))


def test_skewed_trending_and_funnel(skewed):
    df, file = skewed
    _same(op.trending_products(df), _duck(file, (O.PURCHASES, O._trending(5)), "SELECT * FROM trending"))
    _same(op.conversion_funnel(df), _duck(file, (O.SLICES, O.FUNNEL), "SELECT * FROM funnel"))


def test_lookup_join_splits_hot_key(spark):
    from conftest import SF_ORACLE as D
    from sessionmetrics.sources import load_table

    events = load_table(spark, D, "events")
    part = load_table(spark, D, "part").select(
        F.col("p_partkey").alias("_partkey"), F.col("p_type").alias("category")
    )
    hot = F.abs(F.xxhash64("event_id")) % 3 == 0
    # many map tasks, as on a cluster (AQE splits along map-output boundaries)
    left = events.repartition(8).select(
        "event_id", F.when(hot, F.lit(1)).otherwise(F.col("user_id") % 200).alias("_partkey")
    )
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = left.join(part, "_partkey", "left")
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert "SortMergeJoin" in plan and "skew=true" in plan
    assert len(rows) == events.count()

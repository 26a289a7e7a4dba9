"""Physical-plan shape: the plans we want at scale, checked on small data."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from pyspark.sql import functions as F
from sessionmetrics import operators as op
from sessionmetrics.plans import catalog
from sessionmetrics.sources import raw_events


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def clean(spark):
    return op.cleanse_events(raw_events(spark, SF_SMALL))


def _exchanges(plan: str) -> int:
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")


def test_no_cartesian_or_nested_loop(clean):
    for df in (
        op.conversion_funnel(clean),
        op.user_session_metrics(op.session_facts(clean)),
        op.trending_products(clean),
    ):
        p = _plan(df)
        assert "CartesianProduct" not in p
        assert "BroadcastNestedLoopJoin" not in p


def test_trending_limits_before_shuffle(clean):
    p = _plan(op.trending_products(clean))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    assert _exchanges(p) == 2  # (category, product) then category


def test_funnel_two_shuffles_with_partial_aggregates(clean):
    p = _plan(op.conversion_funnel(clean))
    assert _exchanges(p) == 2
    assert p.count("partial_count") >= 2


def test_user_metrics_two_shuffles(clean):
    p = _plan(op.user_session_metrics(op.session_facts(clean)))
    assert _exchanges(p) == 2


def test_scan_reads_only_needed_columns(spark, clean):
    p = _plan(op.product_purchases(clean))
    # the warehouse scan never reads columns the query does not use
    scan = [line for line in p.splitlines() if "FileScan parquet" in line and "user_id" in line]
    assert scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in scan[0]
    funnel = op.session_slices(clean.select("event_ts", "category", "device_type", "user_id", "session_id", "action"))
    assert "price" not in _plan(funnel).split("HashAggregate")[1]


def test_large_n_limits_before_the_category_exchange(spark):
    rows = spark.range(20_000).select(
        F.concat(F.lit("hot"), F.col("id") % 1).alias("category"), F.col("id").cast("string").alias("product_id"),
        (F.col("id") % 977).alias("purchase_count"),
    )
    best = op.top_n_per_group(rows, ["category"], [F.desc("purchase_count"), F.asc("product_id")], 2000)
    plan = _plan(best)
    category = plan.index("hashpartitioning(category#", plan.index("Window"))
    # below the exchange on the category alone, parts of it were ranked and cut
    assert "rn#" in plan[category:] and "<= 2000" in plan[category:] and "_part#" in plan[category:]
    got = [(r.product_id, r.rn) for r in best.orderBy("rn").collect()]
    want = sorted(range(20_000), key=lambda i: (-(i % 977), str(i)))[:2000]
    assert got == [(str(i), n) for n, i in enumerate(want, 1)]


def test_building_a_query_reads_footers_only(spark):
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    before = jobs()
    catalog.queries()["conversion_funnel"](spark, SF_SMALL)
    assert jobs() - before <= 2  # the reader takes the schemas of the two tables


def test_parquet_stage_pushes_filter(spark, clean, scratch):
    path = scratch + "/clean"
    clean.write.parquet(path)
    staged = spark.read.parquet(path)
    p = _plan(op.product_purchases(staged))
    assert "PushedFilters: [IsNotNull(action), EqualTo(action,purchase)]" in p
    assert "ReadSchema: struct<action:string,product_id:string,category:string>" in p


def test_top10_is_take_ordered(clean):
    p = _plan(op.trending_top10(op.trending_products(clean)))
    assert "TakeOrderedAndProject" in p

"""Edge cases: empty input, unclamped rates, shared session ids."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF_ORACLE
from sessionmetrics import operators as op
from sessionmetrics.plans.catalog import QUERIES
from sessionmetrics.schema import EXPECTED_COLUMNS, RAW_SCHEMA
from sessionmetrics.sources import read_raw_events


def test_empty_input_gives_empty_tables_and_zero_reports(spark, scratch):
    folder = os.path.join(scratch, "empty")
    os.makedirs(folder)
    open(os.path.join(folder, "part-00000.json"), "w").close()
    clean = op.cleanse_events(read_raw_events(spark, folder))
    users = op.user_session_metrics(op.session_facts(clean))
    funnel = op.conversion_funnel(clean)
    trending = op.trending_products(clean)
    assert op.is_empty(users) and op.is_empty(funnel) and op.is_empty(trending)
    kpi = op.kpi_summary(users).first()
    assert (kpi.total_users, kpi.total_actions) == (0, 0)
    assert sorted((r.step, r.stage, r["count"]) for r in op.funnel_totals(funnel).collect()) == [
        (1, "view", 0.0), (2, "cart", 0.0), (3, "purchase", 0.0)
    ]
    assert op.trending_top10(trending).count() == 0
    contract = op.schema_contract(
        {"user_session_metrics": users, "trending_products": trending}, EXPECTED_COLUMNS
    ).collect()
    assert all(r.is_empty and r.row_count == 0 for r in contract)


def test_all_rows_rejected(spark):
    df = spark.createDataFrame(
        [("u", "s", "garbage", "view", "p", "c", 1.0, "mobile"),
         ("u", "s", "2024-01-01", "refund", "p", "c", 1.0, "mobile")],
        RAW_SCHEMA,
    )
    assert op.cleanse_events(df).count() == 0


def test_funnel_rates_are_not_clamped(spark):
    funnel = QUERIES["conversion_funnel"](spark, SF_ORACLE)
    top = funnel.agg(F.max("view_to_add_to_cart_rate")).first()[0]
    assert top > 1.0  # slices with a cart but no view: rate above 1 is kept


def test_same_session_id_under_two_users_is_two_sessions(spark):
    rows = [
        ("a", "s1", "2024-01-01T10:00:00Z", "view", "p", "c", 1.0, "mobile"),
        ("b", "s1", "2024-01-01T10:00:05Z", "purchase", "p", "c", 1.0, "mobile"),
    ]
    clean = op.cleanse_events(spark.createDataFrame(rows, RAW_SCHEMA))
    sessions = op.session_facts(clean)
    assert sessions.count() == 2
    assert sorted(r.is_bounce for r in sessions.collect()) == [0, 1]
    funnel = op.conversion_funnel(clean).first()
    assert (funnel.sessions_total, funnel.sessions_with_view, funnel.sessions_with_purchase) == (2, 1, 1)


def test_top_n_keeps_columns_named_like_its_own(spark):
    """Above the planned limit groups are ranked in parts; a caller's columns
    of the same names stay."""
    from pyspark.sql import functions as F

    from sessionmetrics.operators import top_n_per_group

    df = spark.range(3000).select(F.lit("g").alias("g"), "id", (F.col("id") * 2).alias("_part"), F.col("id").alias("_Rank"))
    got = top_n_per_group(df, ["g"], [F.desc("id")], 1500)
    assert got.columns == ["g", "id", "_part", "_Rank", "rn"]
    rows = got.orderBy("rn").collect()
    assert [r.id for r in rows] == list(range(2999, 1499, -1))
    assert all(r["_part"] == 2 * r.id and r["_Rank"] == r.id for r in rows)


def test_top_n_orders_by_a_column_named_like_the_rank(spark):
    """The parts' own rank does not take the place of the caller's column."""
    from pyspark.sql import functions as F

    from sessionmetrics.operators import top_n_per_group

    df = spark.range(3000).select(F.lit("g").alias("g"), "id", (-F.col("id")).alias("rn"))
    for rank_col in ("rn", "RN"):
        got = top_n_per_group(df, ["g"], [F.asc("rn")], 1500, rank_col).orderBy(rank_col).collect()
        assert [r.id for r in got] == list(range(2999, 1499, -1))
        assert [r[rank_col] for r in got] == list(range(1, 1501))

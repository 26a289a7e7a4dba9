"""Hand fixture through the JSON reader: expected tables from FIXTURES.md."""

from __future__ import annotations

import datetime as dt
import math
import os

import pytest

from sessionmetrics import operators as op
from sessionmetrics.sources import read_raw_events


@pytest.fixture()
def clean(spark, fixture_dir):
    return op.cleanse_events(read_raw_events(spark, os.path.join(fixture_dir, "*.json")))


def test_raw_reader_keeps_every_line(spark, fixture_dir):
    raw = read_raw_events(spark, fixture_dir)
    assert raw.count() == 23
    # wrong-typed field -> null, the rest of the row survives
    r8 = raw.where("user_id = 'r8'").collect()
    assert len(r8) == 1 and r8[0].price is None


def test_cleanse_keeps_eleven(clean):
    rows = clean.collect()
    assert len(rows) == 11
    users = sorted({r.user_id for r in rows})
    assert users == ["", "u1", "u2", "u3"]
    assert {r.action for r in rows} <= {"view", "add_to_cart", "purchase"}
    assert {r.device_type for r in rows} <= {"mobile", "desktop", "tablet"}
    assert any(math.isnan(r.price) for r in rows)  # NaN passes the price rule
    u2 = [r for r in rows if r.user_id == "u2"]
    assert {r.device_type for r in u2} == {"mobile", "tablet"}


def test_timestamps_parse_offsets_and_dates(spark, clean):
    got = {
        (r.user_id, r.product_id): r.ts
        for r in clean.selectExpr("user_id", "product_id", "cast(event_ts as string) as ts").collect()
    }
    assert got[("u3", "p2")] == "2024-01-01 10:00:00"  # +02:00 offset
    assert got[("", "p5")] == "2024-01-03 00:00:00"  # date only


def test_time_only_string_is_rejected(spark):
    from sessionmetrics.functions import parse_timestamp
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("12:30",), ("2024-01-01",), ("garbage",)], "t string")
    got = [r.ts for r in df.select(parse_timestamp(F.col("t")).alias("ts")).collect()]
    assert got[0] is None and got[1] is not None and got[2] is None


def test_session_facts(clean):
    rows = {
        (r.user_id, r.session_id): r
        for r in op.session_facts(clean).collect()
    }
    expect = {
        ("", "s9"): (0, 1, 1, 0, 1),
        ("u1", "s1"): (601, 3, 1, 2, 0),
        ("u1", "s2"): (0, 1, 1, 0, 1),
        ("u2", "s3"): (61, 3, 1, 2, 0),
        ("u3", "s1"): (10, 3, 0, 3, 0),
    }
    assert set(rows) == set(expect)
    for k, (dur, n, views, meaningful, bounce) in expect.items():
        r = rows[k]
        assert (
            r.session_duration_seconds,
            r.event_count,
            r.view_count,
            r.meaningful_action_count,
            r.is_bounce,
        ) == (dur, n, views, meaningful, bounce)


def test_user_metrics(clean):
    sessions = op.session_facts(clean)
    users = {r.user_id: r for r in op.user_session_metrics(sessions).collect()}
    documented = {r.user_id: r for r in op.user_metrics_documented(sessions).collect()}
    expect = {
        "": (0.0, 1.0, 1, 1.0, 1, 0),
        "u1": (300.5, 0.5, 4, 2.0, 2, 601),
        "u2": (61.0, 0.0, 3, 3.0, 1, 61),
        "u3": (10.0, 0.0, 3, 3.0, 1, 10),
    }
    assert set(users) == set(expect)
    for uid, (avg_d, bounce, total, avg_a, n, total_d) in expect.items():
        u = users[uid]
        assert (
            u.avg_session_duration_seconds,
            u.bounce_rate,
            u.total_activity_count,
            u.avg_activity_count_per_session,
            u.sessions_count,
        ) == (avg_d, bounce, total, avg_a, n)
        assert documented[uid].total_duration == total_d
        assert documented[uid].total_actions == total


def test_trending(clean):
    got = sorted(tuple(r) for r in op.trending_products(clean, 5).collect())
    assert got == [
        ("books", "p1", 2, 1),
        ("books", "p2", 1, 2),
        ("books", "p4", 1, 3),
        ("fashion", "p3", 1, 1),
    ]
    top1 = sorted(tuple(r) for r in op.trending_products(clean, 1).collect())
    assert top1 == [("books", "p1", 2, 1), ("fashion", "p3", 1, 1)]


def test_funnel(clean):
    d = dt.date
    got = sorted(
        (r.event_date, r.category, r.device_type, r.sessions_with_view,
         r.sessions_with_add_to_cart, r.sessions_with_purchase, r.sessions_total,
         r.view_to_add_to_cart_rate, r.add_to_cart_to_purchase_rate, r.view_to_purchase_rate)
        for r in op.conversion_funnel(clean).collect()
    )
    assert got == [
        (d(2024, 1, 1), "books", "desktop", 0, 0, 1, 1, 0.0, 0.0, 0.0),
        (d(2024, 1, 1), "books", "mobile", 1, 1, 1, 1, 1.0, 1.0, 1.0),
        (d(2024, 1, 1), "fashion", "mobile", 1, 0, 0, 1, 0.0, 0.0, 0.0),
        (d(2024, 1, 2), "books", "desktop", 1, 0, 0, 1, 0.0, 0.0, 0.0),
        (d(2024, 1, 2), "fashion", "mobile", 0, 0, 1, 1, 0.0, 0.0, 0.0),
        (d(2024, 1, 2), "fashion", "tablet", 0, 1, 0, 1, 0.0, 0.0, 0.0),
        (d(2024, 1, 3), "home", "tablet", 1, 0, 0, 1, 0.0, 0.0, 0.0),
    ]


def test_reports(clean):
    users = op.user_session_metrics(op.session_facts(clean))
    funnel = op.conversion_funnel(clean)
    trending = op.trending_products(clean)
    kpi = op.kpi_summary(users).collect()[0]
    assert (kpi.total_users, kpi.total_actions) == (4, 11)
    totals = {r.stage: r["count"] for r in op.funnel_totals(funnel).collect()}
    assert totals == {"view": 4.0, "cart": 2.0, "purchase": 3.0}
    # the same totals through the documented names
    totals_doc = {r.stage: r["count"] for r in op.funnel_totals(op.funnel_documented(funnel)).collect()}
    assert totals_doc == totals
    top = [tuple(r) for r in op.trending_top10(trending).collect()]
    assert top[0] == ("p1", "books", 2, "books • p1")
    assert len(top) == 4


def test_schema_contract_with_preview(clean):
    from sessionmetrics.schema import EXPECTED_COLUMNS

    tables = {
        "user_session_metrics": op.user_session_metrics(op.session_facts(clean)),
        "trending_products": op.trending_products(clean),
    }
    rows = {r.table_name: r for r in op.schema_contract(tables, EXPECTED_COLUMNS, True).collect()}
    users = rows["user_session_metrics"]
    assert users.missing_columns == "" and users.row_count == 4 and not users.is_empty
    assert users.preview.startswith('{"user_id":""')  # smallest user id first
    assert rows["trending_products"].missing_columns == "count"


def test_sorted_trending_order(clean):
    got = [(r.category, r.rn) for r in op.sort_trending(op.trending_products(clean)).collect()]
    assert got == [("books", 1), ("books", 2), ("books", 3), ("fashion", 1)]


def test_permissive_reader_coercions(spark, scratch):
    lines = [
        '{"user_id": 42, "session_id": "s", "timestamp": "2024-01-01T00:00:00Z", "action": "view",'
        ' "product_id": "p", "category": {"a": 1}, "price": 1.0, "device_type": "mobile"}',
        '[{"user_id": "a1", "session_id": "s", "timestamp": "2024-01-01", "action": "view",'
        ' "product_id": "p", "category": "c", "price": 2.0, "device_type": "tablet"},'
        ' {"user_id": "a2", "session_id": "s", "timestamp": "2024-01-01", "action": "view",'
        ' "product_id": "p", "category": "c", "price": 2.0, "device_type": "tablet"}]',
    ]
    folder = os.path.join(scratch, "odd")
    os.makedirs(folder)
    with open(os.path.join(folder, "part-00000.json"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    raw = {r.user_id: r for r in read_raw_events(spark, folder).collect()}
    assert set(raw) == {"42", "a1", "a2"}  # numeric id as text; array line -> 2 rows
    assert raw["42"].category == '{"a": 1}'  # nested object kept as its original text
    assert op.cleanse_events(read_raw_events(spark, folder)).count() == 3


def test_alias_resolution_on_either_naming(spark, clean):
    funnel = op.conversion_funnel(clean)
    a = op.resolve_select(funnel, ["view", "cart", "purchase", "nope"])
    b = op.resolve_select(op.funnel_documented(funnel), ["view", "cart", "purchase", "nope"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert dict(a.dtypes)["nope"] == "string"
    assert op.resolve_column(funnel, "view") == "sessions_with_view"
    assert op.resolve_column(op.funnel_documented(funnel), "view") == "view_count"


def test_output_columns_match_declared_schemas(clean):
    from sessionmetrics import schema as S

    sessions = op.session_facts(clean)
    funnel = op.conversion_funnel(clean)
    trending = op.trending_products(clean)
    assert tuple(clean.columns) == S.CLEAN_COLUMNS
    assert tuple(sessions.columns) == S.SESSION_FACT_COLUMNS
    assert tuple(op.user_session_metrics(sessions).columns) == S.USER_METRIC_COLUMNS
    assert tuple(trending.columns) == S.TRENDING_COLUMNS
    assert tuple(funnel.columns) == S.FUNNEL_COLUMNS
    assert tuple(op.user_metrics_documented(sessions).columns) == S.DOCUMENTED_USER_COLUMNS
    assert tuple(op.funnel_documented(funnel).columns) == S.FUNNEL_KEYS + S.DOCUMENTED_FUNNEL_COLUMNS
    assert tuple(op.trending_documented(trending).columns) == S.DOCUMENTED_TRENDING_COLUMNS
    types = dict(op.user_session_metrics(sessions).dtypes)
    assert types["total_activity_count"] == "bigint" and types["bounce_rate"] == "double"
    assert dict(trending.dtypes)["rn"] == "int" and dict(sessions.dtypes)["is_bounce"] == "int"


def test_rule_without_raw_requirement_keeps_null_rows(spark):
    from pyspark.sql import functions as F

    from sessionmetrics.operators import CLEAN_RULES, FieldRule
    from sessionmetrics.schema import RAW_SCHEMA

    # a custom rule that fills a missing category instead of rejecting it
    rules = tuple(
        FieldRule("category", "category", lambda c: F.coalesce(F.trim(c), F.lit("unknown")),
                  lambda c: c.isNotNull(), requires_raw=False)
        if r.name == "category" else r
        for r in CLEAN_RULES
    )
    df = spark.createDataFrame(
        [("u", "s", "2024-01-01", "view", "p", None, 1.0, "mobile")], RAW_SCHEMA
    )
    assert [r.category for r in op.cleanse_events(df, rules).collect()] == ["unknown"]
    assert op.cleanse_events(df).count() == 0

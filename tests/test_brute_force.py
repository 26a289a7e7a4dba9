"""Random small event sets: Spark operators vs a direct Python computation."""

from __future__ import annotations

import datetime as dt
import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from sessionmetrics import operators as op

CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("action", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("device_type", T.StringType()),
    ]
)
T0 = dt.datetime(2024, 1, 1, 23, 0, 0, tzinfo=dt.timezone.utc)

event = st.tuples(
    st.sampled_from(["u0", "u1", "u2"]),
    st.sampled_from(["s0", "s1"]),
    st.integers(0, 2 * 3600 * 1000),  # ms after 23:00 -> crosses midnight
    st.sampled_from(["view", "add_to_cart", "purchase"]),
    st.sampled_from(["p0", "p1", "p2", "p3"]),
    st.sampled_from(["c0", "c1"]),
    st.sampled_from(["mobile", "desktop", "tablet"]),
)


def _rows(events):
    return [
        (u, s, T0 + dt.timedelta(milliseconds=ms), a, p, c, 1.0, d) for u, s, ms, a, p, c, d in events
    ]


def _sec(ts):
    return math.floor(ts.timestamp())


def _expected(rows, n):
    sess = defaultdict(list)
    for r in rows:
        sess[(r[0], r[1])].append(r)
    facts = {}
    for key, evs in sess.items():
        start, end = min(e[2] for e in evs), max(e[2] for e in evs)
        meaningful = sum(e[3] in ("add_to_cart", "purchase") for e in evs)
        facts[key] = (len(evs), sum(e[3] == "view" for e in evs), meaningful,
                      _sec(end) - _sec(start), int(meaningful == 0))
    users = defaultdict(list)
    for (u, _), f in facts.items():
        users[u].append(f)
    user_rows = {
        u: (sum(f[3] for f in fs) / len(fs), sum(f[4] for f in fs) / len(fs),
            sum(f[0] for f in fs), sum(f[0] for f in fs) / len(fs), len(fs))
        for u, fs in users.items()
    }
    counts = defaultdict(int)
    for r in rows:
        if r[3] == "purchase":
            counts[(r[5], r[4])] += 1
    trending = set()
    for cat in {c for c, _ in counts}:
        ranked = sorted(((-k, p) for (c, p), k in counts.items() if c == cat))
        for i, (negk, p) in enumerate(ranked[:n], start=1):
            trending.add((cat, p, -negk, i))
    slices = defaultdict(set)
    for r in rows:
        slices[(r[2].date(), r[5], r[7], r[0], r[1])].add(r[3])
    cells = defaultdict(lambda: [0, 0, 0, 0])
    for (d, c, dev, _, _), acts in slices.items():
        cell = cells[(d, c, dev)]
        cell[0] += "view" in acts
        cell[1] += "add_to_cart" in acts
        cell[2] += "purchase" in acts
        cell[3] += 1
    rate = lambda a, b: a / b if b > 0 else 0.0
    funnel = {
        k: (v, c, p, t, rate(c, v), rate(p, c), rate(p, v)) for k, (v, c, p, t) in cells.items()
    }
    return facts, user_rows, trending, funnel


@settings(max_examples=10, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=40), st.integers(1, 3))
def test_operators_match_brute_force(spark, events, n):
    rows = _rows(events)
    clean = spark.createDataFrame(rows, CLEAN_SCHEMA)
    facts, users, trending, funnel = _expected(rows, n)

    got_facts = {
        (r.user_id, r.session_id): (r.event_count, r.view_count, r.meaningful_action_count,
                                    r.session_duration_seconds, r.is_bounce)
        for r in op.session_facts(clean).collect()
    }
    assert got_facts == facts

    got_users = {
        r.user_id: (r.avg_session_duration_seconds, r.bounce_rate, r.total_activity_count,
                    r.avg_activity_count_per_session, r.sessions_count)
        for r in op.user_session_metrics(op.session_facts(clean)).collect()
    }
    assert got_users.keys() == users.keys()
    for u, vals in users.items():
        assert all(math.isclose(a, b) for a, b in zip(got_users[u], vals)), u

    got_trending = {tuple(r) for r in op.trending_products(clean, n).collect()}
    assert got_trending == trending

    got_funnel = {
        (r.event_date, r.category, r.device_type): (
            r.sessions_with_view, r.sessions_with_add_to_cart, r.sessions_with_purchase,
            r.sessions_total, r.view_to_add_to_cart_rate, r.add_to_cart_to_purchase_rate,
            r.view_to_purchase_rate)
        for r in op.conversion_funnel(clean).collect()
    }
    assert got_funnel == funnel

"""Property test: the Spark cleanse equals a plain-Python model of its rules
on random raw rows (padding, case, tabs, NaN/inf, boundary prices, zones)."""

from __future__ import annotations

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sessionmetrics.operators import cleanse_events
from sessionmetrics.schema import RAW_SCHEMA

ids = st.one_of(st.none(), st.sampled_from(["u1", " u1", "u1 ", "  ", "", "U1", "u\t1"]))
actions = st.one_of(
    st.none(),
    st.sampled_from(["view", " View ", "ADD_TO_CART", "purchase ", "view\t", "refund", ""]),
)
devices = st.one_of(st.none(), st.sampled_from(["mobile", " Desktop", "TABLET ", "tv", "mobile\t"]))
prices = st.one_of(
    st.none(),
    st.sampled_from([0.0, 0.0099, 0.01, 0.011, 12.5, math.nan, math.inf, -math.inf, -1.0]),
)
zones = {"": 0, "Z": 0, "+02:00": 120, "-05:30": -330}


@st.composite
def stamps(draw):
    kind = draw(st.sampled_from(["full", "date", "bad"]))
    if kind == "bad":
        text = draw(st.sampled_from(["garbage", "12:30", "", "2024-13-01", "24-01-01"]))
        return text, None
    day = draw(st.integers(1, 28))
    if kind == "date":
        return f"2024-02-{day:02d}", dt.datetime(2024, 2, day)
    h, m, s = draw(st.integers(0, 23)), draw(st.integers(0, 59)), draw(st.integers(0, 59))
    micros = draw(st.sampled_from([0, 500000, 123456]))
    sep = draw(st.sampled_from(["T", " "]))
    zone = draw(st.sampled_from(sorted(zones)))
    frac = f".{micros:06d}" if micros else ""
    text = f"2024-02-{day:02d}{sep}{h:02d}:{m:02d}:{s:02d}{frac}{zone}"
    local = dt.datetime(2024, 2, day, h, m, s, micros)
    return text, local - dt.timedelta(minutes=zones[zone])


rows = st.lists(
    st.tuples(ids, ids, stamps(), actions, ids, ids, prices, devices), min_size=1, max_size=25
)


def _model(raw):
    user, session, (ts_text, ts), action, product, category, price, device = raw
    strip = lambda v: None if v is None else v.strip(" ")  # noqa: E731 - spaces only
    act = None if action is None else action.strip(" ").lower()
    dev = None if device is None else device.strip(" ").lower()
    ok = (
        strip(user) is not None
        and strip(session) is not None
        and ts is not None
        and act in ("view", "add_to_cart", "purchase")
        and strip(product) is not None
        and strip(category) is not None
        and price is not None
        and (math.isnan(price) or price >= 0.01)
        and dev in ("mobile", "desktop", "tablet")
    )
    if not ok:
        return None
    return (strip(user), strip(session), ts, act, strip(product), strip(category), repr(price), dev)


@settings(max_examples=12, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_cleanse_matches_model(spark, sample):
    data = [(u, s, t[0], a, p, c, pr, d) for (u, s, t, a, p, c, pr, d) in sample]
    df = spark.createDataFrame(data, RAW_SCHEMA)
    out = cleanse_events(df).selectExpr(
        "user_id", "session_id", "cast(event_ts as timestamp_ntz) as ts", "action",
        "product_id", "category", "price", "device_type",
    )
    got = sorted(
        (r.user_id, r.session_id, r.ts, r.action, r.product_id, r.category, repr(r.price), r.device_type)
        for r in out.collect()
    )
    want = sorted(m for m in map(_model, sample) if m is not None)
    assert got == want

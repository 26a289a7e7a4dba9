from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

TESTS = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(TESTS)
sys.path.insert(0, TESTS)
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sessionmetrics.session import build_session

    s = build_session(
        "sessionmetrics-tests",
        master="local[4]",
        shuffle_partitions=8,
        conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="sm-test-")


# ---------------------------------------------------------------------------
# Hand fixture: 11 kept + 12 rejected JSON lines (see FIXTURES.md).
# ---------------------------------------------------------------------------
def _ev(user, session, ts, action, product, category, price, device):
    return {
        "user_id": user,
        "session_id": session,
        "timestamp": ts,
        "action": action,
        "product_id": product,
        "category": category,
        "price": price,
        "device_type": device,
    }


KEPT = [
    _ev("u1", "s1", "2024-01-01T10:00:00+00:00", "view", "p1", "books", 10.0, "mobile"),
    _ev("u1", "s1", "2024-01-01T10:05:00.900000+00:00", "add_to_cart", "p1", "books", 10.0, "mobile"),
    _ev("u1", "s1", "2024-01-01T10:10:01.100000+00:00", "purchase", "p1", "books", 10.0, "mobile"),
    _ev("u1", "s2", "2024-01-02T09:00:00+00:00", "view", "p2", "books", 5.0, "desktop"),
    _ev(" u2 ", "s3", "2024-01-01T23:59:59.900000+00:00", " View ", "p3", "fashion", 7.5, "MOBILE"),
    _ev("u2", "s3", "2024-01-02T00:00:30+00:00", "purchase", "p3", "fashion", 7.5, "mobile"),
    _ev("u2", "s3", "2024-01-02T00:01:00.100000+00:00", "add_to_cart", "p3", "fashion", 0.01, "tablet"),
    _ev("u3", "s1", "2024-01-01T12:00:00+02:00", "purchase", "p2", "books", 5.0, "desktop"),
    _ev("u3", "s1", "2024-01-01T10:00:00Z", "purchase", "p1", "books", 10.0, "desktop"),
    None,  # u3 s1 with a bare NaN price, written by hand below
    _ev("   ", "s9", "2024-01-03", "view", "p5", "home", 1.0, "tablet"),
]
NAN_LINE = (
    '{"user_id": "u3", "session_id": "s1", "timestamp": "2024-01-01T10:00:10Z", '
    '"action": "purchase", "product_id": "p4", "category": "books", "price": NaN, '
    '"device_type": "desktop"}'
)


def _rejected():
    base = lambda n: _ev(f"r{n}", "x", "2024-01-01T10:00:00Z", "view", "p1", "books", 1.0, "mobile")
    rows = []
    rows.append("this is not json")
    r = base(2); r["timestamp"] = "garbage"; rows.append(r)
    r = base(3); r["action"] = "refund"; rows.append(r)
    r = base(4); r["price"] = 0.0099; rows.append(r)
    r = base(5); r["price"] = None; rows.append(r)
    r = base(6); r["device_type"] = "tv"; rows.append(r)
    r = base(7); del r["session_id"]; rows.append(r)
    r = base(8); r["price"] = "12.5"; rows.append(r)
    r = base(9); r["category"] = None; rows.append(r)
    r = base(10); del r["product_id"]; rows.append(r)
    r = base(11); r["action"] = "view\t"; rows.append(r)
    r = base(12); r["user_id"] = None; rows.append(r)
    return rows


def fixture_lines() -> list[str]:
    lines = [NAN_LINE if e is None else json.dumps(e) for e in KEPT]
    lines += [r if isinstance(r, str) else json.dumps(r) for r in _rejected()]
    return lines


@pytest.fixture()
def fixture_dir(scratch):
    """The 23 lines split over two part files, like a folder of JSON lines."""
    lines = fixture_lines()
    folder = os.path.join(scratch, "raw")
    os.makedirs(folder)
    half = len(lines) // 2
    for i, chunk in enumerate((lines[:half], lines[half:])):
        with open(os.path.join(folder, f"part-{i:05d}.json"), "w") as fh:
            fh.write("\n".join(chunk) + "\n")
    return folder

"""bench.py prints exactly one JSON line with every query timed."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from sessionmetrics.plans import catalog
from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_WARMUP="0", BENCH_COPIES="2", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
        text=True, timeout=900, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001 and not result["errors"]
    expected = set(catalog.queries()) | {"job_end_to_end", "job_end_to_end_x2"}
    assert set(result["queries"]) == expected
    assert all(v > 0 for v in result["queries"].values())
    assert result["value"] == round(sum(result["queries"].values()), 4)

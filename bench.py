"""Benchmark: every catalogued query plus the end-to-end job.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all
cores), BENCH_REPEAT (default 5; the median is reported), BENCH_COPIES
(default 10: input copies for the parallel job entry), BENCH_DRIVER_MEMORY,
BENCH_WARMUP (default 1: one untimed pass over all queries first).  Each query is
built and fully executed into the no-op sink (no collect).  Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from functools import reduce

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from sessionmetrics.plans import catalog  # noqa: E402
from sessionmetrics.plans.job import run_job  # noqa: E402
from sessionmetrics.session import build_session, scratch_path  # noqa: E402
from sessionmetrics.sources import raw_events, write_jsonl  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


FASTEST: dict[str, float] = {}


def _timed(fn, repeat: int, name: str | None = None) -> float:
    """Median wall time of ``repeat`` runs (the fastest is kept in FASTEST)."""
    times = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    if name:
        FASTEST[name] = round(min(times), 4)
    return statistics.median(times)


def _driver_memory() -> str:
    """Half the machine's memory, capped at 8 GB (env BENCH_DRIVER_MEMORY wins)."""
    if os.environ.get("BENCH_DRIVER_MEMORY"):
        return os.environ["BENCH_DRIVER_MEMORY"]
    try:
        with open("/proc/meminfo") as fh:
            kb = int(next(l for l in fh if l.startswith("MemTotal")).split()[1])
        return f"{max(1, min(8, kb // (2 * 1024 * 1024)))}g"
    except (OSError, StopIteration, ValueError):
        return "2g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = build_session(
        "sessionmetrics-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=max(2, cpus),
        conf={
            "spark.driver.memory": _driver_memory(),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    queries = catalog.queries()
    # One untimed pass over every query warms the JVM (class loading, JIT,
    # codegen caches) so the timed runs measure the steady state.
    if os.environ.get("BENCH_WARMUP", "1") != "0":
        for q in queries.values():
            try:
                _run(q(spark, sf_dir))
            except Exception:  # reported by the timed run below
                pass

    results: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name, q in queries.items():
        try:
            results[name] = round(_timed(lambda q=q: _run(q(spark, sf_dir)), repeat, name), 4)
        except Exception as exc:  # keep benchmarking the rest; report the failure
            results[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"

    def job_entry(name: str, copies: int) -> int:
        """Write ``copies`` of the raw events as JSON lines (untimed), then
        time the whole job over them.  Returns the number of input events."""
        try:
            raw = raw_events(spark, sf_dir)
            src = scratch_path(spark, f"bench-json-{copies}")
            data = reduce(lambda a, b: a.unionByName(b), [raw] * copies)
            write_jsonl(data, src, records_per_file=25_000 if copies == 1 else 50_000)
            out = lambda: run_job(spark, src, scratch_path(spark, "bench-out"), mode="overwrite")
            results[name] = round(_timed(out, repeat, name), 4)
            return raw.count() * copies
        except Exception as exc:
            results[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            return 0

    # End-to-end job: read JSON lines -> cleanse -> stage -> three outputs.
    job_entry("job_end_to_end", 1)
    # The same job over ten copies of the raw events in several files, so the
    # scan runs as parallel tasks (rows repeat; the job does not deduplicate).
    copies = int(os.environ.get("BENCH_COPIES", "10"))
    key = f"job_end_to_end_x{copies}"
    n_events = job_entry(key, copies)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(v for v in results.values() if v is not None), 4),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "repeat": repeat,
        "job_events": n_events,
        "job_events_per_sec": round(n_events / results[key]) if results.get(key) else None,
        "warmup": os.environ.get("BENCH_WARMUP", "1") != "0",
        "errors": errors,
        "queries_min": FASTEST,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

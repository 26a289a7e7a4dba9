"""Job throughput on a larger JSON-lines input derived from the given tables.

    python scripts/scale_probe.py <fresh scratch folder> [sf_dir] [copies] [--hot]

Writes the raw events of ``sf_dir`` ``copies`` times as JSON lines (rows
repeat; nothing is deduplicated, as in the job), then times the job once
per reuse mode, twice (the second round is warm).  ``--hot`` puts about a
third of all rows under one user and one session (a skewed key) to check
that the plan does not funnel them through one task.
"""

import os
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from sessionmetrics.session import build_session
from sessionmetrics.sources import raw_events, write_jsonl
from sessionmetrics.plans.job import run_job
args = [a for a in sys.argv[1:] if a != "--hot"]
hot = "--hot" in sys.argv
base = args[0]
sf_dir = args[1] if len(args) > 1 else "/root/testdata/sf0.1"
copies = int(args[2]) if len(args) > 2 else 10
spark = build_session(master="local[8]", shuffle_partitions=16, conf={"spark.ui.showConsoleProgress":"false","spark.driver.memory":"8g"})
spark.sparkContext.setLogLevel("ERROR")
src = os.path.join(base, "json")
raw = raw_events(spark, sf_dir)
big = reduce(lambda a, b: a.unionByName(b), [raw] * copies)
if hot:
    from pyspark.sql import functions as F

    pick = F.abs(F.xxhash64(*big.columns, F.monotonically_increasing_id())) % 3 == 0
    big = big.withColumns({
        "user_id": F.when(pick, F.lit("hot-user")).otherwise(F.col("user_id")),
        "session_id": F.when(pick, F.lit("hot-session")).otherwise(F.col("session_id")),
    })
n = big.count()
t0 = time.perf_counter(); write_jsonl(big, src, records_per_file=50_000); print("write json %.1fs" % (time.perf_counter()-t0))
print("files", len([f for f in os.listdir(src) if f.endswith(".json")]))
for rep in range(2):
    for reuse in ("stage", "persist", "none"):
        t0 = time.perf_counter()
        run_job(spark, src, os.path.join(base, f"out-{reuse}-{rep}"), mode="overwrite", reuse=reuse)
        dt_ = time.perf_counter() - t0
        print(f"{reuse:8s} {dt_:.2f}s  {n / dt_:,.0f} events/s", flush=True)
spark.stop()

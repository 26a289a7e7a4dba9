"""Write PLANS.md: the final (post-AQE) physical plans of the main queries.

    python scripts/show_plans.py [sf_dir]

Each query is executed once (small results at sf0.01) so its adaptive plan
is final; long expression lists are shortened to keep the operator tree
readable.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sessionmetrics import operators as op  # noqa: E402
from sessionmetrics.plans import catalog  # noqa: E402
from sessionmetrics.plans.job import OUTPUT_INPUTS, compute_outputs  # noqa: E402
from sessionmetrics.session import build_session, scratch_path  # noqa: E402
from sessionmetrics.sources import raw_events, write_table  # noqa: E402

SHOW = [
    "clean_events",
    "session_facts",
    "user_session_metrics",
    "trending_products",
    "conversion_funnel",
    "kpi_summary",
    "trending_top10",
]


def _short(line: str, width: int = 150) -> str:
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r", \[plan_id=\d+\]", "", line)
    if "FileScan" in line:
        # keep what shows pruning and pushdown: columns, pushed filters, read schema
        head = line[: line.index("FileScan")] + line[line.index("FileScan"):].split(" Batched")[0]
        pushed = re.search(r"PushedFilters: \[[^\]]*\]", line)
        schema = re.search(r"ReadSchema: \S+", line)
        return " ".join([head] + [m.group(0) for m in (pushed, schema) if m])
    return line if len(line) <= width else line[: width - 3] + "..."


def tree(df) -> str:
    df.collect()  # runs this DataFrame's own adaptive plan to its final form
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("+- == Initial Plan ==")[0]
    return "\n".join(_short(l) for l in plan.splitlines() if l.strip())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "sessionmetrics-plans", master="local[8]", shuffle_partitions=8,
        conf={"spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    out = [
        "# Physical plans",
        "",
        f"Final adaptive plans on `{os.path.basename(sf_dir.rstrip('/'))}`, generated by "
        "`scripts/show_plans.py` (expression lists shortened). `*(n)` marks whole-stage codegen.",
        "",
    ]
    for name in SHOW:
        out += [f"## {name}", "", "```", tree(catalog.QUERIES[name](spark, sf_dir)), "```", ""]
    path = scratch_path(spark, "clean-events")
    write_table(op.cleanse_events(raw_events(spark, sf_dir)).select(*OUTPUT_INPUTS), path)
    for name, df in compute_outputs(spark.read.parquet(path)).items():
        out += [f"## job: {name} (over staged clean parquet)", "", "```", tree(df), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""The dashboard's analytics as a Spark job over the stored metric tables.

    python -m sessionmetrics.plans.report --output out/ [--write reports/]

Reads the three tables the job wrote (S3, store ``_id`` dropped) and builds
the report tables: KPIs (R1), funnel totals (R2), top-10 products (R3),
schema contract (R5/R6), row counts and previews (R10).  Every report is
small by construction (one row per KPI set, stage or table; ten or fifty
rows for the top-k and previews), so ``--show`` prints them; ``--write``
stores them as parquet instead.  The metric tables are read whole - no
row cap.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .. import operators as op
from ..schema import EXPECTED_COLUMNS, PREVIEW_ROWS
from ..session import build_session
from ..sources import Summary, read_table, write_table
from .job import OUTPUT_TABLES, summaries


def load_outputs(
    spark: SparkSession,
    output: str,
    fmt: str = "parquet",
    names: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The job's three tables read back from ``output`` (names overridable)."""
    names = {**{t: t for t in OUTPUT_TABLES}, **dict(names or {})}
    return {t: read_table(spark, os.path.join(output, names[t]), fmt=fmt) for t in OUTPUT_TABLES}


def build_reports(
    tables: Mapping[str, DataFrame], recorded: Mapping[str, Summary] | None = None
) -> dict[str, DataFrame]:
    """All report tables from the metric tables (lazy).  Counts and first rows
    that the job recorded are taken from there."""
    users = tables["user_session_metrics"]
    funnel = tables["conversion_funnel_metrics"]
    trending = tables["trending_products"]
    return {
        "kpi_summary": op.kpi_summary(users),
        "funnel_totals": op.funnel_totals(funnel),
        "trending_top10": op.trending_top10(trending),
        "schema_contract": op.schema_contract(tables, EXPECTED_COLUMNS, with_preview=True, recorded=recorded),
        "table_row_counts": op.table_row_counts(tables, recorded),
        **{
            # ordered by every column: a total order, so the preview is stable
            f"preview_{name}": op.preview(df, df.columns, PREVIEW_ROWS)
            for name, df in tables.items()
        },
    }


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Report tables over stored session metrics.")
    p.add_argument("--output", required=True, help="folder the job wrote its tables to")
    p.add_argument("--format", default="parquet")
    p.add_argument("--target", action="append", default=[], help="table=name as given to the job")
    p.add_argument("--write", default=None, help="folder to write the report tables to")
    p.add_argument("--show", action="store_true", help="print the report tables")
    return p.parse_args(argv)


def main(argv=None, stop_session: bool = True) -> dict[str, DataFrame]:
    args = parse_args(argv)
    spark = build_session("sessionmetrics-report")
    try:
        targets = dict(kv.split("=", 1) for kv in args.target)
        tables = load_outputs(spark, args.output, args.format, targets)
        recorded = summaries(spark, args.output, targets)
        empty = [
            name for name, df in tables.items()
            if (recorded[name].row_count == 0 if name in recorded else op.is_empty(df))
        ]
        if len(empty) == len(tables):
            print("all metric tables are empty: run the job first", file=sys.stderr)
        elif empty:
            print(f"empty metric tables: {', '.join(empty)}", file=sys.stderr)
        reports = build_reports(tables, recorded)
        for name, df in reports.items():
            if args.write:
                write_table(df, os.path.join(args.write, name), mode="overwrite")
            if args.show or not args.write:
                print(f"== {name}")
                df.show(PREVIEW_ROWS, truncate=False)
        return reports
    finally:
        if stop_session:
            spark.stop()


if __name__ == "__main__":
    main()

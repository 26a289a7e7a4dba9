"""The batch job - JSON-lines events in, three metric tables out.

    python -m sessionmetrics.plans.job --input 'data/*.json' --output out/

Plan for a large input:
  1. scan + cleanse is one map-only stage; what the outputs read of its
     result is written once as parquet under the shared checkpoint folder and
     removed at the end.  That cuts the lineage (a lost executor re-reads
     parquet, not the JSON) and lets each aggregate read only the columns it
     needs.
  2. the three tables are independent aggregate plans over that table;
     every one pre-aggregates map-side before its shuffle, so hot users,
     sessions or categories are collapsed per task first.
  3. the three writes are submitted as concurrent Spark jobs, so the small
     final stages of one overlap the scans of the others.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import operators as op
from ..schema import DEFAULT_TOP_N
from ..session import build_session, remove_path, scratch_path
from ..sources import Summary, read_raw_events, read_summary, reused, split_malformed, write_summarised, write_table
from ..sources.batches import commit_batch, committed_batches, read_batches, write_batch

log = logging.getLogger(__name__)

OUTPUT_TABLES = ("user_session_metrics", "trending_products", "conversion_funnel_metrics")
REUSE_MODES = ("stage", "persist", "none")


# What the three outputs read of a clean event.
OUTPUT_INPUTS = ("user_id", "session_id", "event_ts", "action", "product_id", "category", "device_type")


@contextmanager
def clean_events(
    spark: SparkSession, input_path: str | list[str] | None, reuse: str = "stage",
    clean_table: str | None = None, keep_clean: str | None = None, rejections: str | None = None,
    malformed: str | None = None,
) -> Iterator[DataFrame]:
    """Clean events for the actions of a block, shared as ``reuse`` says.

    ``keep_clean`` writes all their columns to a table that stays;
    otherwise a staged table holds what the outputs read and goes with the
    block.  ``rejections`` names a path for the number of rows that each rule
    rejects, counted while clean events are written; ``malformed`` one for
    the text of lines that do not parse."""
    if clean_table is not None:
        yield spark.read.parquet(clean_table)
        return
    if rejections is not None and keep_clean is None and reuse != "stage":
        raise ValueError("rejections are counted while clean events are written")
    raw = read_raw_events(spark, input_path) if malformed is None else split_malformed(spark, input_path, malformed)[0]
    clean, seen = op.cleanse_counted(raw) if rejections is not None else (op.cleanse_events(raw), None)

    def count() -> None:
        if rejections is not None:
            rows = spark.createDataFrame(op.rejection_rows(seen.get), "rule string, rejected long, only_rule long")
            write_table(rows.coalesce(1), rejections, mode="overwrite")

    if keep_clean is not None:
        write_table(clean, keep_clean, mode="overwrite")
        count()
        yield spark.read.parquet(keep_clean)
    elif reuse == "persist":
        with reused(clean) as kept:
            yield kept
    elif reuse == "none":
        yield clean
    else:
        staged = scratch_path(spark, "clean-events")
        log.info("clean events staged at %s", staged)
        try:
            write_table(clean.select(*OUTPUT_INPUTS), staged)
            count()
            yield spark.read.parquet(staged)
        finally:
            remove_path(spark, staged)


def compute_outputs(clean: DataFrame, top_n: int = DEFAULT_TOP_N) -> dict[str, DataFrame]:
    """The three metric tables from clean events (lazy)."""
    return {
        "user_session_metrics": op.user_session_metrics(op.session_facts(clean)),
        "trending_products": op.trending_products(clean, top_n=top_n),
        "conversion_funnel_metrics": op.conversion_funnel(clean),
    }


def names_of(targets: Mapping[str, str] | None) -> dict[str, str]:
    """The name under which each output is stored."""
    return {**{t: t for t in OUTPUT_TABLES}, **dict(targets or {})}


def _batch_outputs(spark: SparkSession, output: str, names: Mapping[str, str]) -> dict[str, DataFrame]:
    """The outputs of all finished batches."""
    batches = committed_batches(spark, output)
    schemas = batches[-1].note["schemas"]
    return {
        table: read_batches(
            spark, os.path.join(output, names[table]), StructType.fromJson(json.loads(schemas[table])),
            [b.id for b in batches],
        )
        for table in OUTPUT_TABLES
    }


def summaries(
    spark: SparkSession, output: str, targets: Mapping[str, str] | None = None
) -> dict[str, Summary]:
    """What the writers of the outputs recorded, where that still holds."""
    found = {table: read_summary(spark, os.path.join(output, name)) for table, name in names_of(targets).items()}
    return {table: summary for table, summary in found.items() if summary is not None}


def run_job(
    spark: SparkSession,
    input_path: str | list[str],
    output: str,
    top_n: int = DEFAULT_TOP_N,
    fmt: str = "parquet",
    mode: str = "append",
    options: Mapping[str, str] | None = None,
    clean_table: str | None = None,
    reuse: str = "stage",
    targets: Mapping[str, str] | None = None,
    parallel_writes: bool = True,
    keep_clean: str | None = None,
    as_database: bool = False,
    batch_id: str | None = None,
    rejections: str | None = None,
    malformed: str | None = None,
) -> dict[str, DataFrame | None]:
    """Run the job; returns the written tables read back (None for sinks that
    are no path).

    ``clean_table`` starts from an already cleansed parquet table (for
    instance the one the streaming ingest maintains) instead of JSON lines;
    ``keep_clean`` names a path where the cleansed table is to stay.
    ``reuse`` says how the three outputs share clean events: ``"stage"``
    (default; parquet in the shared folder, removed at the end - survives
    executor loss and prunes columns), ``"persist"`` (executor memory and
    disk, released at the end) or ``"none"`` (each output re-reads the input).
    Each table goes to ``output/<name>``; with ``as_database``, for
    document-store and similar sinks, ``output`` is passed as the ``database``
    option and the name as ``collection``, next to ``options``.  ``targets``
    renames outputs (``{"trending_products": "top_products"}``); others keep
    their table name.  With ``parallel_writes`` the three writes are submitted
    as concurrent Spark jobs, so one output's small final stages overlap the
    others' scans instead of leaving executors idle.  Every write is tried;
    all errors are raised together.

    With ``batch_id`` the rows are appended under that id, once: a run that
    was killed between its writes, or is started again, replaces its own rows
    (parquet only), and a batch that was finished before is not run again.
    The tables read back are then those of all finished batches.
    ``rejections`` and ``malformed`` name paths for the counts and lines that
    ``clean_events`` keeps; both replace what was there.
    """
    if reuse not in REUSE_MODES:
        raise ValueError(f"reuse must be one of {REUSE_MODES}")
    if batch_id is not None and (fmt != "parquet" or as_database or mode != "append"):
        raise ValueError("batch_id goes with appends of parquet to a path")
    if batch_id is not None and batch_id in (b.id for b in committed_batches(spark, output)):
        log.info("batch %s is there already", batch_id)
        return _batch_outputs(spark, output, names_of(targets))
    names = names_of(targets)

    def write(table: str, df: DataFrame) -> Exception | None:
        name = names[table]
        try:
            if as_database:
                opts = {"database": output, "collection": name, **dict(options or {})}
                write_table(df, None, fmt=fmt, mode=mode, options=opts)
            elif batch_id is not None:
                write_batch(df, os.path.join(output, name), batch_id)
            else:
                write_summarised(df, os.path.join(output, name), fmt, mode, options)
        except Exception as error:
            return error
        return None

    with clean_events(spark, input_path, reuse, clean_table, keep_clean, rejections, malformed) as clean:
        outputs = compute_outputs(clean, top_n)
        workers = len(outputs) if parallel_writes else 1
        with ThreadPoolExecutor(max_workers=workers) as pool:
            errors = [e for e in pool.map(write, outputs, outputs.values()) if e is not None]
    if len(errors) == 1:
        raise errors[0]
    if errors:
        raise ExceptionGroup("writing the outputs failed", errors)
    if as_database:
        return {table: None for table in outputs}
    if batch_id is not None:
        schemas = {table: df.schema.json() for table, df in outputs.items()}
        commit_batch(spark, output, batch_id, {"schemas": schemas})
        return _batch_outputs(spark, output, names)
    # text formats keep no types: the schema is the one just written
    return {
        table: spark.read.format(fmt).schema(df.schema).options(**dict(options or {}))
        .load(os.path.join(output, names[table]))
        for table, df in outputs.items()
    }


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Clickstream session, trending and funnel metrics.")
    p.add_argument("--input", default=None, help="path or glob of JSON-lines event files")
    p.add_argument("--output", required=True, help="output folder (or database for other sinks)")
    p.add_argument("--app-name", default="sessionmetrics")
    p.add_argument("--top-n", type=int, default=DEFAULT_TOP_N)
    p.add_argument("--format", default="parquet")
    p.add_argument("--mode", default="append", choices=["append", "overwrite", "error", "ignore"])
    p.add_argument("--option", action="append", default=[], help="sink option key=value")
    p.add_argument("--target", action="append", default=[],
                   help="output name override table=name (tables: " + ", ".join(OUTPUT_TABLES) + ")")
    p.add_argument("--shuffle-partitions", type=int, default=None, help="default: cluster setting")
    p.add_argument("--initial-partitions", type=int, default=None,
                   help="shuffle partitions to start from; adaptive execution coalesces them. Size it so "
                   "that the largest shuffle leaves a few hundred MB each (100 TB of events: 200000)")
    p.add_argument("--reuse", choices=REUSE_MODES, default="stage",
                   help="how outputs share clean events: stage (parquet), persist, none")
    p.add_argument("--clean-table", default=None, help="start from a cleansed parquet table")
    p.add_argument("--keep-clean", default=None, help="path where the cleansed table is to stay")
    p.add_argument("--as-database", action="store_true", help="the sink takes database and collection, not paths")
    p.add_argument("--rejections", default=None, help="path for the number of rows each rule rejects")
    p.add_argument("--malformed", default=None, help="path for events and the lines that do not parse")
    p.add_argument("--batch-id", default=None, help="append under this id, once, also if the run is repeated")
    args = p.parse_args(argv)
    if args.input is None and args.clean_table is None:
        p.error("--input or --clean-table is required")
    return args


def main(argv=None, stop_session: bool = True) -> None:
    """CLI entry; ``stop_session=False`` leaves a shared session running."""
    args = parse_args(argv)
    pkg = logging.getLogger("sessionmetrics")
    pkg.setLevel(logging.INFO)
    if not pkg.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(levelname)s %(name)s: %(message)s"))
        pkg.addHandler(handler)
    options = dict(kv.split("=", 1) for kv in args.option)
    targets = dict(kv.split("=", 1) for kv in args.target)
    unknown = set(targets) - set(OUTPUT_TABLES)
    if unknown:
        raise SystemExit(f"unknown output table(s): {', '.join(sorted(unknown))}")
    conf = {}
    if args.initial_partitions:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(args.initial_partitions)
    spark = build_session(args.app_name, shuffle_partitions=args.shuffle_partitions, conf=conf)
    try:
        run_job(
            spark,
            args.input,
            args.output,
            top_n=args.top_n,
            fmt=args.format,
            mode=args.mode,
            options=options,
            reuse=args.reuse,
            targets=targets,
            clean_table=args.clean_table,
            keep_clean=args.keep_clean,
            as_database=args.as_database,
            batch_id=args.batch_id,
            rejections=args.rejections,
            malformed=args.malformed,
        )
    finally:
        if stop_session:
            spark.stop()


if __name__ == "__main__":
    main()

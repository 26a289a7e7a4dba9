"""Incremental ingest of JSON-lines event files (S1 + P1 as a file stream).

The same reader schema and cleanse as the batch job, run with Structured
Streaming: each run picks up only files it has not seen (tracked in the
checkpoint), cleanses them and appends to a parquet table through the
file sink, whose commit log makes the append exactly-once.  Rerunning after
a failure therefore neither loses nor duplicates events - unlike a plain
batch append.  The batch job then reads the table as its clean input.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import cleanse_events
from ..schema import RAW_SCHEMA


def read_raw_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Streaming S1: new JSON-lines files under ``path`` with the raw schema.

    ``options`` go to the file source, e.g. ``cleanSource`` /
    ``sourceArchiveDir`` to move processed files away (keeps listing cheap
    as the folder grows) or ``maxFileAge``."""
    reader = spark.readStream.schema(RAW_SCHEMA).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    reader = reader.options(**dict(options or {}))
    return reader.json(path)


def start_clean_ingest(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    source_options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start the ingest stream ``source`` (folder of JSON lines) -> ``table``
    (parquet folder).  ``checkpoint`` must stay the same across runs; it
    defaults to a sibling folder of the table.

    ``available_now=True`` processes everything new and stops (a scheduled
    incremental batch); otherwise it runs continuously on
    ``processing_time`` triggers.
    """
    clean = cleanse_events(read_raw_stream(spark, source, max_files_per_trigger, source_options))
    writer = (
        clean.writeStream.format("parquet")
        .outputMode("append")
        .option("path", table)
        .option("checkpointLocation", checkpoint or table.rstrip("/") + "_checkpoint")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def ingest_available(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str | None = None,
    source_options: Mapping[str, str] | None = None,
) -> None:
    """Process every file not yet ingested, then return."""
    query = start_clean_ingest(
        spark, source, table, checkpoint, available_now=True, source_options=source_options
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def main(argv=None) -> None:
    """CLI: ``python -m sessionmetrics.streaming.ingest --source in/ --table clean/``."""
    import argparse

    from ..session import build_session

    p = argparse.ArgumentParser(description="Cleanse new JSON-lines event files into a parquet table.")
    p.add_argument("--source", required=True, help="folder the event files arrive in")
    p.add_argument("--table", required=True, help="parquet folder of clean events")
    p.add_argument("--checkpoint", default=None, help="stream checkpoint (default: <table>_checkpoint)")
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    p.add_argument("--source-option", action="append", default=[], help="file-source option key=value")
    p.add_argument("--continuous", action="store_true", help="keep running instead of stopping when caught up")
    p.add_argument("--trigger", default="1 minute", help="processing-time trigger for --continuous")
    args = p.parse_args(argv)
    spark = build_session("sessionmetrics-ingest")
    query = start_clean_ingest(
        spark,
        args.source,
        args.table,
        args.checkpoint,
        available_now=not args.continuous,
        processing_time=args.trigger if args.continuous else None,
        max_files_per_trigger=args.max_files_per_trigger,
        source_options=dict(kv.split("=", 1) for kv in args.source_option),
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


if __name__ == "__main__":
    main()

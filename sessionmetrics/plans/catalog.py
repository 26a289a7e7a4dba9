"""Query catalogue: every operator of the job and its reports, run over the
warehouse tables in ``sf_dir``.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  The operator entries are lazy.  Round trips and the job write their
input when called, and the report entries write the metric tables they report
on, once, as reports run over stored tables.  Timestamps are returned as
TIMESTAMP_NTZ (UTC wall clock) so they compare with zone-less SQL timestamps.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..schema import DEFAULT_TOP_N, EXPECTED_COLUMNS, FUNNEL_KEYS, PREVIEW_ROWS
from ..session import pin_utc, scratch_path
from ..sources import (
    Summary,
    first_documents,
    load_table,
    raw_events,
    read_raw_events,
    read_table,
    register_documents,
    split_malformed,
    write_batch,
    write_jsonl,
    write_table,
)
from ..sources.documents import FORMAT as DOCUMENT_FILES
from ..streaming import ingest_available
from .incremental import read_outputs, run_batch
from .job import OUTPUT_INPUTS, run_job, summaries

Query = Callable[[SparkSession, str], DataFrame]


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return op.cleanse_events(raw_events(spark, sf_dir))


def _sessions(spark, sf_dir):
    return op.session_facts(_clean(spark, sf_dir))


def _users(spark, sf_dir):
    return op.user_session_metrics(_sessions(spark, sf_dir))


def _trending(spark, sf_dir, n=DEFAULT_TOP_N):
    return op.trending_products(_clean(spark, sf_dir), top_n=n)


def _slices(spark, sf_dir):
    return op.session_slices(_clean(spark, sf_dir))


def _funnel(spark, sf_dir):
    return op.funnel(_slices(spark, sf_dir))


def _stored(spark, sf_dir) -> tuple[dict[str, DataFrame], dict[str, Summary]]:
    """The three metric tables as stored by the job, and what it recorded of
    them: one scan of the raw events, then everything reported is read from
    parquet or from the record."""
    base = scratch_path(spark, "reported")
    clean = f"{base}/clean"
    write_table(_clean(spark, sf_dir).select(*OUTPUT_INPUTS), clean)
    return run_job(spark, None, f"{base}/out", clean_table=clean), summaries(spark, f"{base}/out")


def _stored_table(spark, sf_dir, name) -> DataFrame:
    """One metric table, written once and read back."""
    make = {"user_session_metrics": _users, "trending_products": _trending, "conversion_funnel_metrics": _funnel}
    path = scratch_path(spark, name)
    write_table(make[name](spark, sf_dir), path)
    return read_table(spark, path)


def _schema_contract(spark, sf_dir):
    tables, recorded = _stored(spark, sf_dir)
    # the same funnel under its second naming scheme
    tables["funnel_documented"] = op.funnel_documented(tables["conversion_funnel_metrics"])
    expected = {**EXPECTED_COLUMNS, "funnel_documented": EXPECTED_COLUMNS["conversion_funnel_metrics"]}
    return op.schema_contract(tables, expected, with_preview=True, recorded=recorded)


def _job_output(name: str, reuse: str) -> Query:
    """Write the raw events as JSON lines, run the whole job over them and
    read one of its outputs back."""

    def run(spark, sf_dir):
        base = scratch_path(spark, "job")
        write_jsonl(raw_events(spark, sf_dir), f"{base}/in", records_per_file=25_000)
        return run_job(spark, f"{base}/in", f"{base}/out", reuse=reuse)[name]

    return run


def _incremental_output(name: str) -> Query:
    """Events arrive in two batches: those up to a day, and the later ones
    with every seventh of the earlier, which come late.  The second run reads
    its own files and what is stored of the days and sessions they touch."""

    def run(spark, sf_dir):
        base = scratch_path(spark, "incremental")
        raw = raw_events(spark, sf_dir, keep=("event_id", "ts"))
        bounds = raw.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
        split = (bounds.lo + (bounds.hi - bounds.lo) * 2 / 3).replace(hour=12) if bounds.lo else bounds.lo
        late = (F.col("ts") > F.lit(split).cast("timestamp_ntz")) | (F.col("event_id") % 7 == 0)
        marked = raw.withColumn("batch", F.when(F.coalesce(late, F.lit(True)), "second").otherwise("first"))
        marked.drop("event_id", "ts").write.partitionBy("batch").json(f"{base}/in")
        for batch in ("first", "second"):
            run_batch(spark, f"{base}/in/batch={batch}", f"{base}/state", batch)
        return read_outputs(spark, f"{base}/state")[name]

    return run


def _rejections(spark, sf_dir):
    """How many rows each rule rejects, counted by the pass that writes the
    clean events."""
    clean, seen = op.cleanse_counted(raw_events(spark, sf_dir))
    write_table(clean, scratch_path(spark, "counted"))
    return spark.createDataFrame(op.rejection_rows(seen.get), "rule string, rejected long, only_rule long")


def _malformed_lines(spark, sf_dir):
    """The text of lines that do not parse: some of the events end early, some
    have a price that is no number."""
    base = scratch_path(spark, "lines")
    eid, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    good = F.to_json(F.struct(user.alias("user_id"), F.col("event_type").alias("action"), F.col("value").alias("price")))
    line = (
        F.when(F.col("event_id") % 89 == 0, F.concat(F.lit('{"user_id": "'), user, F.lit('", "action": "ends early '), eid))
        .when(F.col("event_id") % 83 == 0, F.concat(F.lit('{"user_id": "'), user, F.lit('", "price": "dear '), eid, F.lit('"}')))
        .otherwise(good)
    )
    load_table(spark, sf_dir, "events").select(line.alias("value")).write.text(f"{base}/in")
    return split_malformed(spark, f"{base}/in", f"{base}/split")[1]


def _batch_append(spark, sf_dir):
    """Two batches appended, the first one run twice and the second one after
    a try that ended between its writes."""
    base = scratch_path(spark, "batches")
    clean = f"{base}/clean"
    write_table(_clean(spark, sf_dir).select(*OUTPUT_INPUTS), clean)
    for _ in range(2):
        run_job(spark, None, f"{base}/out", clean_table=clean, batch_id="one")
    write_batch(_users(spark, sf_dir).limit(10), f"{base}/out/user_session_metrics", "two")
    return run_job(spark, None, f"{base}/out", clean_table=clean, batch_id="two")["user_session_metrics"]


def _store_readback(spark, sf_dir):
    """A stored table with the store's own ``_id``, read back without it,
    first rows under a total order."""
    path = scratch_path(spark, "documents")
    users = _users(spark, sf_dir)
    write_table(users.withColumn("_id", F.sha1("user_id")), path)
    return read_table(spark, path, order_by=["user_id"], limit=PREVIEW_ROWS)


def _document_store(spark, sf_dir, make=_users, first=None):
    """A metric table appended to a document store in small batches and read
    back, or its first documents alone."""
    register_documents(spark)
    path = scratch_path(spark, "document-store")
    options = {"batchSize": "64", "writeConcern.w": "majority"}
    write_table(make(spark, sf_dir), path, fmt=DOCUMENT_FILES, options=options)
    return read_table(spark, path, fmt=DOCUMENT_FILES) if first is None else first_documents(spark, path, first)


def _sorted_trending(spark, sf_dir):
    return op.sort_trending(_trending(spark, sf_dir))


def _lenient_users(spark, sf_dir):
    """User metrics whose actions came back as text, some of it no number."""
    uid = F.col("user_id").cast("long")
    shown = F.col("total_activity_count").cast("string")
    text = F.when(uid % 7 == 0, F.lit("NaN")).when(uid % 7 == 1, F.lit("n/a")).when(uid % 7 == 2, F.lit(None)).otherwise(shown)
    return _users(spark, sf_dir).select("user_id", text.alias("total_actions"))


def _lenient_trending(spark, sf_dir):
    """Trending products whose counts came back as doubles with NaN and null."""
    k = F.substring("product_id", 2, 9).cast("long")
    count = F.col("purchase_count").cast("double")
    value = F.when(k % 5 == 0, F.lit(float("nan"))).when(k % 5 == 1, F.lit(None)).otherwise(count)
    return _trending(spark, sf_dir).select("product_id", "category", value.alias("count"))


def _jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "raw-jsonl")
    write_jsonl(raw_events(spark, sf_dir), path, records_per_file=25_000)
    return read_raw_events(spark, path)


def _stream_ingest(spark, sf_dir):
    base = scratch_path(spark, "stream")
    source = os.path.join(base, "incoming")
    write_jsonl(raw_events(spark, sf_dir), source, records_per_file=25_000)
    table = os.path.join(base, "clean")
    ingest_available(spark, source, table, os.path.join(base, "checkpoint"))
    return _ntz(read_table(spark, table), "event_ts")


def _sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "user-metrics")
    write_table(_users(spark, sf_dir), path, mode="append")
    return read_table(spark, path)


QUERIES: dict[str, Query] = {
    "raw_events": lambda s, d: raw_events(s, d),
    "clean_events": lambda s, d: _ntz(_clean(s, d), "event_ts"),
    "session_facts": lambda s, d: _ntz(_sessions(s, d), "session_start_ts", "session_end_ts"),
    "session_facts_from_slices": lambda s, d: _ntz(
        op.sessions_from_slices(_slices(s, d)), "session_start_ts", "session_end_ts"
    ),
    "user_session_metrics": _users,
    "user_metrics_documented": lambda s, d: op.user_metrics_documented(_sessions(s, d)),
    "product_purchases": lambda s, d: op.product_purchases(_clean(s, d)),
    "trending_products": _trending,
    "trending_products_top1": lambda s, d: _trending(s, d, 1),
    "trending_products_top2000": lambda s, d: _trending(s, d, 2000),
    "trending_documented": lambda s, d: op.trending_documented(_trending(s, d)),
    "trending_sorted": lambda s, d: op.sort_trending(_trending(s, d)),
    "session_slices": lambda s, d: _ntz(_slices(s, d), "first_ts", "last_ts"),
    "session_slice_flags": lambda s, d: op.slice_flags(_slices(s, d)),
    "conversion_funnel": _funnel,
    "funnel_documented": lambda s, d: op.funnel_documented(_funnel(s, d)),
    "kpi_summary": lambda s, d: op.kpi_summary(_stored_table(s, d, "user_session_metrics")),
    "kpi_summary_lenient": lambda s, d: op.kpi_summary(_lenient_users(s, d)),
    "funnel_totals": lambda s, d: op.funnel_totals(_stored_table(s, d, "conversion_funnel_metrics")),
    "trending_top10": lambda s, d: op.trending_top10(_stored_table(s, d, "trending_products")),
    "trending_top10_lenient": lambda s, d: op.trending_top10(_lenient_trending(s, d)),
    "alias_resolution": lambda s, d: op.resolve_select(_users(s, d), ["user_id", "total_actions"]),
    "metrics_preview": lambda s, d: op.preview(_stored_table(s, d, "user_session_metrics"), ["user_id"]),
    "funnel_preview": lambda s, d: op.preview(_stored_table(s, d, "conversion_funnel_metrics"), FUNNEL_KEYS),
    "trending_preview": lambda s, d: op.preview(_stored_table(s, d, "trending_products"), ["category", "rn"]),
    "table_row_counts": lambda s, d: op.table_row_counts(*_stored(s, d)),
    "schema_contract": _schema_contract,
    "jsonl_roundtrip": _jsonl_roundtrip,
    "sink_append_roundtrip": _sink_roundtrip,
    "store_readback": _store_readback,
    "document_store_append": _document_store,
    "document_store_first": lambda s, d: _document_store(s, d, _sorted_trending, PREVIEW_ROWS),
    "stream_ingest_roundtrip": _stream_ingest,
    "job_user_metrics": _job_output("user_session_metrics", "stage"),
    "job_trending": _job_output("trending_products", "persist"),
    "job_funnel": _job_output("conversion_funnel_metrics", "stage"),
    "cleanse_rejections": _rejections,
    "malformed_lines": _malformed_lines,
    "job_batch_append": _batch_append,
    "incremental_user_metrics": _incremental_output("user_session_metrics"),
    "incremental_trending": _incremental_output("trending_products"),
    "incremental_funnel": _incremental_output("conversion_funnel_metrics"),
}


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)  # before any plan is analysed
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _in_utc(q) for name, q in QUERIES.items()}

"""Readers, sinks and the end-to-end job."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sessionmetrics import operators as op
from sessionmetrics.plans.job import main as job_main
from sessionmetrics.plans.job import run_job
from sessionmetrics.session import shared_dir
from sessionmetrics.sources import (
    load_table,
    raw_events,
    read_raw_events,
    read_table,
    reused,
    write_jsonl,
    write_table,
)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_jsonl_roundtrip_with_file_size(spark, scratch):
    raw = raw_events(spark, SF_SMALL)
    path = os.path.join(scratch, "jsonl")
    write_jsonl(raw, path, records_per_file=300)
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    assert len(files) >= raw.count() // 300
    back = read_raw_events(spark, path)
    assert _rows(back) == _rows(raw)


def test_append_twice_doubles_overwrite_does_not(spark, scratch):
    users = op.user_session_metrics(op.session_facts(op.cleanse_events(raw_events(spark, SF_SMALL))))
    n = users.count()
    path = os.path.join(scratch, "users")
    write_table(users, path)
    write_table(users, path)
    assert read_table(spark, path).count() == 2 * n
    write_table(users, path, mode="overwrite")
    assert _rows(read_table(spark, path)) == _rows(users)


def test_read_back_drops_store_id_and_caps_in_order(spark, scratch):
    df = spark.range(20).select(F.col("id").alias("_id"), (F.col("id") * 2).alias("v"))
    path = os.path.join(scratch, "docs")
    write_table(df, path, fmt="json", mode="overwrite")
    back = read_table(spark, path, fmt="json", limit=5, order_by=["v"])
    assert back.columns == ["v"]
    assert [r.v for r in back.collect()] == [0, 2, 4, 6, 8]


def test_limit_needs_an_order(spark, scratch):
    path = os.path.join(scratch, "t")
    write_table(spark.range(3), path)
    with pytest.raises(ValueError, match="order_by"):
        read_table(spark, path, limit=1)


def test_reused_releases_also_after_an_error(spark):
    with reused(spark.range(10)) as df:
        assert df.is_cached and df.count() == 10
    assert not df.is_cached
    with pytest.raises(RuntimeError):
        with reused(spark.range(10)) as df:
            raise RuntimeError
    assert not df.is_cached



def test_shared_dir_comes_from_session(spark):
    d = shared_dir(spark)
    assert d
    assert shared_dir(spark) == d


def test_job_end_to_end(spark, fixture_dir, scratch):
    out = os.path.join(scratch, "out")
    run_job(spark, os.path.join(fixture_dir, "*.json"), out, top_n=5, mode="overwrite")
    users = read_table(spark, os.path.join(out, "user_session_metrics"))
    trending = read_table(spark, os.path.join(out, "trending_products"))
    funnel = read_table(spark, os.path.join(out, "conversion_funnel_metrics"))
    assert users.count() == 4
    assert trending.count() == 4
    assert funnel.count() == 7
    kpi = op.kpi_summary(users).first()
    assert (kpi.total_users, kpi.total_actions) == (4, 11)


def test_job_rerun_appends(spark, fixture_dir, scratch):
    out = os.path.join(scratch, "out")
    src = os.path.join(fixture_dir, "*.json")
    run_job(spark, src, out, reuse="none")
    run_job(spark, src, out, reuse="none")
    assert read_table(spark, os.path.join(out, "user_session_metrics")).count() == 8


def test_job_cli(spark, fixture_dir, scratch):
    out = os.path.join(scratch, "cli")
    job_main(["--input", os.path.join(fixture_dir, "*.json"), "--output", out, "--mode", "overwrite",
              "--top-n", "1", "--target", "trending_products=top_products"], stop_session=False)
    assert sorted(os.listdir(out)) == ["conversion_funnel_metrics", "top_products", "user_session_metrics"]
    trending = read_table(spark, os.path.join(out, "top_products"))
    assert sorted(r.product_id for r in trending.collect()) == ["p1", "p3"]


def test_job_reuse_modes_agree(spark, fixture_dir, scratch):
    src = os.path.join(fixture_dir, "*.json")
    results = {}
    for reuse in ("stage", "persist", "none"):
        out = os.path.join(scratch, reuse)
        run_job(spark, src, out, mode="overwrite", reuse=reuse)
        results[reuse] = {
            t: _rows(read_table(spark, os.path.join(out, t)))
            for t in ("user_session_metrics", "trending_products", "conversion_funnel_metrics")
        }
    assert results["stage"] == results["persist"] == results["none"]
    assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()


def test_job_cli_needs_an_input(scratch):
    with pytest.raises(SystemExit):
        job_main(["--output", scratch], stop_session=False)


def _scratch_entries(spark):
    root = shared_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(root) if n.startswith("clean-events")}


def test_job_leaves_only_its_outputs(spark, fixture_dir, scratch):
    before = _scratch_entries(spark)
    src, out = os.path.join(fixture_dir, "*.json"), os.path.join(scratch, "out")
    written = run_job(spark, src, out)
    assert _scratch_entries(spark) == before
    assert sorted(os.listdir(out)) == ["conversion_funnel_metrics", "trending_products", "user_session_metrics"]
    assert written["user_session_metrics"].count() == 4  # read back, not from the staged table
    with pytest.raises(ExceptionGroup):
        run_job(spark, src, out, mode="error")
    assert _scratch_entries(spark) == before


def test_kept_clean_table_has_all_columns(spark, fixture_dir, scratch):
    kept = os.path.join(scratch, "clean")
    run_job(spark, os.path.join(fixture_dir, "*.json"), os.path.join(scratch, "out"), keep_clean=kept)
    assert "price" in spark.read.parquet(kept).columns
    again = run_job(spark, None, os.path.join(scratch, "again"), clean_table=kept)
    assert again["user_session_metrics"].count() == 4


def test_all_write_errors_are_raised(spark, fixture_dir, scratch):
    src, out = os.path.join(fixture_dir, "*.json"), os.path.join(scratch, "out")
    run_job(spark, src, out)
    with pytest.raises(ExceptionGroup) as caught:
        run_job(spark, src, out, mode="error")
    assert len(caught.value.exceptions) == 3


def test_table_is_read_afresh(spark, scratch):
    path = os.path.join(scratch, "events.parquet")
    write_table(spark.range(10), path)
    assert load_table(spark, scratch, "events").count() == 10
    write_table(spark.range(10), path)
    assert load_table(spark, scratch, "events").count() == 20


def test_jsonl_files_hold_at_most_n_rows(spark, scratch):
    path = os.path.join(scratch, "jsonl")
    raw = raw_events(spark, SF_SMALL)
    write_jsonl(raw.repartition(3), path, records_per_file=128)
    counts = []
    for name in os.listdir(path):
        if name.endswith(".json"):
            with open(os.path.join(path, name)) as fh:
                counts.append(sum(1 for _ in fh))
    assert counts and max(counts) <= 128 and sum(counts) == raw.count()



def test_report_job_over_stored_outputs(spark, fixture_dir, scratch):
    from sessionmetrics.plans.report import main as report_main

    out = os.path.join(scratch, "out")
    run_job(spark, os.path.join(fixture_dir, "*.json"), out, mode="overwrite")
    rep = os.path.join(scratch, "reports")
    report_main(["--output", out, "--write", rep], stop_session=False)
    kpi = read_table(spark, os.path.join(rep, "kpi_summary")).first()
    assert (kpi.total_users, kpi.total_actions) == (4, 11)
    totals = {r.stage: r["count"] for r in read_table(spark, os.path.join(rep, "funnel_totals")).collect()}
    assert totals == {"view": 4.0, "cart": 2.0, "purchase": 3.0}
    assert read_table(spark, os.path.join(rep, "trending_top10")).count() == 4
    counts = {r.table_name: r.row_count for r in read_table(spark, os.path.join(rep, "table_row_counts")).collect()}
    assert counts == {"user_session_metrics": 4, "trending_products": 4, "conversion_funnel_metrics": 7}
    assert read_table(spark, os.path.join(rep, "preview_user_session_metrics")).count() == 4


def test_parallel_writes_raise_the_failure(spark, fixture_dir, scratch):
    out = os.path.join(scratch, "twice")
    src = os.path.join(fixture_dir, "*.json")
    run_job(spark, src, out, mode="error", reuse="none")
    with pytest.raises(ExceptionGroup) as caught:
        run_job(spark, src, out, mode="error", reuse="none")
    assert all("already exists" in str(e).lower() for e in caught.value.exceptions)


def test_job_non_path_sink_gets_database_and_collection(spark, fixture_dir):
    # "noop" is a sink without a path that accepts any options, like a
    # document-store connector would take database / collection / batch size
    outputs = run_job(
        spark, os.path.join(fixture_dir, "*.json"), "analytics", fmt="noop", mode="overwrite", as_database=True,
        options={"batchSize": "500", "writeConcern.w": "1"},
    )
    assert set(outputs) == {"user_session_metrics", "trending_products", "conversion_funnel_metrics"}


def test_partitioned_table_round_trip(spark, scratch):
    funnel = op.conversion_funnel(op.cleanse_events(raw_events(spark, SF_SMALL)))
    path = os.path.join(scratch, "funnel")
    write_table(funnel, path, mode="overwrite", partition_by=["event_date"])
    assert any(d.startswith("event_date=") for d in os.listdir(path))
    back = read_table(spark, path).select(*funnel.columns)
    assert _rows(back) == _rows(funnel)

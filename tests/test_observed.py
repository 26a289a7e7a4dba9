"""What is counted and kept while rows are written: rejections, malformed
lines, summaries of tables."""

from __future__ import annotations

import glob
import json
import os

import pytest

from conftest import fixture_lines
from sessionmetrics import operators as op
from sessionmetrics.plans.job import OUTPUT_TABLES, run_job, summaries
from sessionmetrics.plans.report import build_reports, load_outputs
from sessionmetrics.sources import (
    read_raw_events,
    read_summary,
    read_table,
    split_malformed,
    write_summarised,
    write_table,
)


def rows_of(df) -> list:
    return sorted(str(tuple(r)) for r in df.collect())


def jobs_run(spark, group, action):
    """The jobs an action starts."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = action()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return out, spark.sparkContext.statusTracker().getJobIdsForGroup(group)


def test_rejections_of_the_hand_fixture(spark, fixture_dir, scratch):
    raw = read_raw_events(spark, os.path.join(fixture_dir, "*.json"))
    clean, seen = op.cleanse_counted(raw)
    write_table(clean, os.path.join(scratch, "clean"))
    counts = seen.get
    assert (counts["read"], counts["kept"]) == (23, 11)
    assert rows_of(spark.read.parquet(os.path.join(scratch, "clean"))) == rows_of(op.cleanse_events(raw))
    # the line that is no JSON fails every rule; each of the others fails one
    only = {rule: n for rule, _, n in op.rejection_rows(counts)}
    assert only == {
        "user_id": 1, "session_id": 1, "event_ts": 1, "action": 2, "product_id": 1, "category": 1, "price": 3, "device_type": 1,
    }
    assert {rule: n for rule, n, _ in op.rejection_rows(counts)} == {rule: n + 1 for rule, n in only.items()}


def test_rejections_take_one_pass(spark, fixture_dir, scratch):
    raw = read_raw_events(spark, os.path.join(fixture_dir, "*.json"))
    clean, seen = op.cleanse_counted(raw)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan json") == 1 and "CollectMetrics" in plan
    _, jobs = jobs_run(spark, "one-pass", lambda: (write_table(clean, os.path.join(scratch, "t")), seen.get))
    assert len(jobs) == 1


def test_job_keeps_rejections_and_malformed_lines(spark, fixture_dir, scratch):
    src, out = os.path.join(fixture_dir, "*.json"), os.path.join(scratch, "out")
    plain = run_job(spark, src, os.path.join(scratch, "plain"))
    kept = run_job(
        spark, src, out, rejections=os.path.join(scratch, "rejected"), malformed=os.path.join(scratch, "lines")
    )
    assert {t: rows_of(kept[t]) for t in OUTPUT_TABLES} == {t: rows_of(plain[t]) for t in OUTPUT_TABLES}
    rejected = {r.rule: (r.rejected, r.only_rule) for r in spark.read.parquet(os.path.join(scratch, "rejected")).collect()}
    assert rejected["device_type"] == (1, 1)
    # lines that do not parse are no events any more
    assert rejected["price"] == (2, 2)
    lines = spark.read.parquet(os.path.join(scratch, "lines")).where("malformed = true").select("_corrupt_record")
    assert sorted(r[0] for r in lines.collect()) == sorted(
        text for text in fixture_lines() if not text.startswith("{") or '"price": "12.5"' in text
    )
    with pytest.raises(ValueError):
        run_job(spark, src, out, reuse="none", rejections=os.path.join(scratch, "x"))


def test_split_lines(spark, scratch):
    folder = os.path.join(scratch, "in")
    os.makedirs(folder)
    good = [{"user_id": "a", "price": 1.5}, {"user_id": 7}, {}, {"extra": [1]}]
    bad = ['{"user_id": "b"', "[", '{"price": "x", "user_id": "c"}', "é not json", '{"user_id": "d"} trailing' * 0 or "nul"]
    with open(os.path.join(folder, "part.json"), "w") as file:
        file.write("\n".join([json.dumps(g) for g in good] + bad + ["", "  "]))
    events, lines = split_malformed(spark, folder, os.path.join(scratch, "split"))
    assert sorted(r.line for r in lines.collect()) == sorted(bad)
    assert sorted(map(str, (r.user_id for r in events.collect()))) == ["7", "None", "None", "a"]
    assert events.columns == read_raw_events(spark, folder).columns
    # an empty folder has neither
    os.makedirs(os.path.join(scratch, "none"))
    events, lines = split_malformed(spark, os.path.join(scratch, "none"), os.path.join(scratch, "split-none"))
    assert events.count() == lines.count() == 0


def test_summary_holds_for_its_files_only(spark, scratch):
    path = os.path.join(scratch, "t")
    df = spark.createDataFrame([(2, "x", None), (1, "y", 0.5)], "a long, b string, c double").repartition(3)
    assert read_summary(spark, path) is None
    summary = write_summarised(df, path)
    assert read_summary(spark, path) == summary
    assert (summary.row_count, summary.columns, json.loads(summary.first)) == (2, ("a", "b", "c"), {"a": 1, "b": "y", "c": 0.5})
    assert read_table(spark, path).count() == 2
    # rows appended beside it, by this writer or another
    assert write_summarised(df, path) is None and read_summary(spark, path) is None
    summary = write_summarised(df.where("a = 2"), path, mode="overwrite")
    assert read_summary(spark, path) == summary and summary.row_count == 1
    write_table(df, path)
    assert read_summary(spark, path) is None
    # no rows, formats without files, modes that write nothing
    empty = write_summarised(df.limit(0), os.path.join(scratch, "empty"))
    assert (empty.row_count, empty.first) == (0, None)
    assert write_summarised(df, os.path.join(scratch, "noop"), fmt="noop", mode="overwrite") is None
    assert write_summarised(df, path, mode="ignore") is None
    assert write_summarised(df, os.path.join(scratch, "json"), fmt="json").row_count == 2


def test_reports_from_the_record_scan_nothing(spark, fixture_dir, scratch):
    out = os.path.join(scratch, "out")
    run_job(spark, os.path.join(fixture_dir, "*.json"), out)
    tables, recorded = load_outputs(spark, out), summaries(spark, out)
    assert set(recorded) == set(OUTPUT_TABLES)
    scanned, told = build_reports(tables), build_reports(tables, recorded)
    for name in ("schema_contract", "table_row_counts"):
        assert rows_of(told[name]) == rows_of(scanned[name])
        assert told[name].schema == scanned[name].schema or told[name].dtypes == scanned[name].dtypes
        assert "Scan parquet" not in told[name]._jdf.queryExecution().executedPlan().toString()
    # a second run appends: the record no longer holds, the tables are counted
    run_job(spark, os.path.join(fixture_dir, "*.json"), out)
    assert summaries(spark, out) == {}
    counts = {r.table_name: r.row_count for r in build_reports(load_outputs(spark, out), {})["table_row_counts"].collect()}
    assert counts == {t: 2 * recorded[t].row_count for t in OUTPUT_TABLES}
    assert not glob.glob(os.path.join(out, "*", "*.tmp"))

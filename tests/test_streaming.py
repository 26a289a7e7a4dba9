"""File-stream ingest: exactly-once appends across runs."""

from __future__ import annotations

import os

from conftest import fixture_lines
from sessionmetrics import operators as op
from sessionmetrics.sources import read_raw_events, read_table
from sessionmetrics.streaming import ingest_available


def _write(folder, name, lines):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_ingest_is_incremental_and_exactly_once(spark, scratch):
    src = os.path.join(scratch, "incoming")
    table = os.path.join(scratch, "clean")
    os.makedirs(src)
    lines = fixture_lines()
    _write(src, "part-00000.json", lines[:5])
    ingest_available(spark, src, table)
    first = read_table(spark, table).count()

    _write(src, "part-00001.json", lines[5:])
    ingest_available(spark, src, table)
    ingest_available(spark, src, table)  # nothing new: no duplicates

    got = read_table(spark, table)
    want = op.cleanse_events(read_raw_events(spark, src))
    assert first < got.count() == want.count() == 11
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(repr(tuple(r)) for r in want.collect())

    # the batch metrics run on the ingested table as on freshly cleansed data
    users = op.user_session_metrics(op.session_facts(got))
    assert users.count() == 4


def test_job_runs_on_ingested_table(spark, scratch, fixture_dir):
    from sessionmetrics.plans.job import run_job

    table = os.path.join(scratch, "clean")
    ingest_available(spark, fixture_dir, table)
    out = os.path.join(scratch, "out")
    run_job(spark, None, out, mode="overwrite", clean_table=table)
    funnel = read_table(spark, os.path.join(out, "conversion_funnel_metrics"))
    assert funnel.count() == 7


def test_ingest_can_archive_processed_files(spark, scratch):
    src = os.path.join(scratch, "incoming")
    archive = os.path.join(scratch, "archive")
    table = os.path.join(scratch, "clean")
    os.makedirs(src)
    _write(src, "part-00000.json", fixture_lines())
    ingest_available(
        spark, src, table,
        source_options={"cleanSource": "archive", "sourceArchiveDir": archive},
    )
    # every row arrives; Spark moves processed files to the archive in the
    # background after the commit, so their location is not asserted here
    assert read_table(spark, table).count() == 11


def test_ingest_cli(spark, scratch):
    from sessionmetrics.streaming.ingest import main as ingest_main

    src = os.path.join(scratch, "incoming")
    table = os.path.join(scratch, "clean")
    os.makedirs(src)
    _write(src, "part-00000.json", fixture_lines()[:5])
    _write(src, "part-00001.json", fixture_lines()[5:])
    ingest_main(["--source", src, "--table", table, "--max-files-per-trigger", "1"])
    assert read_table(spark, table).count() == 11

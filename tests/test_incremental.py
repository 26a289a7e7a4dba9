"""Batches: the incremental job against one run over everything, reruns of
killed and finished batches."""

from __future__ import annotations

import glob
import json
import os
import random
import shutil

import pytest

from sessionmetrics.plans import incremental
from sessionmetrics.plans.job import compute_outputs, run_job
from sessionmetrics.operators import cleanse_events
from sessionmetrics.sources import commit_batch, committed_batches, read_batches, read_raw_events, write_batch

TABLES = ("user_session_metrics", "trending_products", "conversion_funnel_metrics")


def events(seed: int, n: int, first_day: int, last_day: int) -> list[dict]:
    """Sessions of many days, categories and devices; some lines are bad."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        user = f"u{rng.randint(0, 12)}"
        out.append({
            "user_id": user, "session_id": f"s{rng.randint(0, 15)}",
            "timestamp": f"2024-01-{rng.randint(first_day, last_day):02d}T{rng.randint(0, 23):02d}:30:{rng.randint(0, 59):02d}Z",
            "action": rng.choice(["view", "view", "add_to_cart", "purchase", "refund"]),
            "product_id": f"p{rng.randint(0, 8)}", "category": rng.choice(["books", "home"]),
            "price": rng.choice([1.0, 5.0, None]), "device_type": rng.choice(["mobile", "desktop"]),
        })
    return out


def store(folder: str, name: str, rows: list[dict]) -> str:
    path = os.path.join(folder, name)
    os.makedirs(path)
    with open(os.path.join(path, "part.json"), "w") as file:
        file.writelines(json.dumps(r) + "\n" for r in rows)
    return path


def rows_of(df) -> list:
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def assert_like_one_run(spark, root, paths):
    clean = cleanse_events(read_raw_events(spark, paths))
    want, got = compute_outputs(clean), incremental.read_outputs(spark, root)
    for table in TABLES:
        assert dict(got[table].dtypes) == dict(want[table].dtypes)
        assert got[table].columns == want[table].columns
        assert rows_of(got[table]) == rows_of(want[table]), table


def test_batches_equal_one_run(spark, scratch):
    root = os.path.join(scratch, "root")
    batches = [events(1, 60, 1, 4), events(3, 40, 2, 9), [], events(4, 5, 20, 20)]
    paths = []
    for i, rows in enumerate(batches):
        paths.append(store(scratch, f"in{i}", rows))
        assert incremental.run_batch(spark, paths[-1], root, f"2024-{i}")
        assert_like_one_run(spark, root, paths)
    # a finished batch is not run again, its input not even looked at
    assert not incremental.run_batch(spark, os.path.join(scratch, "nowhere"), root, "2024-2")
    assert_like_one_run(spark, root, paths)
    assert [b.id for b in committed_batches(spark, root)] == [f"2024-{i}" for i in range(4)]
    # totals of the last two batches are kept
    assert len(os.listdir(os.path.join(root, "users"))) <= 3


def test_reads_new_files_and_touched_days_only(spark, scratch):
    root = os.path.join(scratch, "root")
    first = store(scratch, "first", events(5, 80, 1, 10))
    later = [dict(e, session_id="s1", user_id="u1") for e in events(6, 10, 10, 11)]
    second = store(scratch, "second", later)
    incremental.run_batch(spark, first, root, "first")
    want = [first + "-moved", second]
    shutil.copytree(first, want[0])
    # what must not be read cannot be: the first batch's events, and slices of days before the 10th
    with open(os.path.join(first, "part.json"), "w") as file:
        file.write("gone")
    spoilt = 0
    for path in glob.glob(os.path.join(root, "slices", "_batch=first", "event_date=*", "*.parquet")):
        if "event_date=2024-01-10" not in path:
            with open(path, "wb") as file:
                file.write(b"spoilt")
            spoilt += 1
    assert spoilt > 5
    assert incremental.run_batch(spark, second, root, "second")
    assert_like_one_run(spark, root, want)


def test_only_days_of_touched_sessions_are_opened(spark, scratch):
    root = os.path.join(scratch, "root")
    incremental.run_batch(spark, store(scratch, "first", events(7, 80, 1, 10)), root, "first")
    alone = [dict(e, user_id="new", session_id="n1") for e in events(8, 5, 3, 3)]
    incremental.run_batch(spark, store(scratch, "second", alone), root, "second")
    state = incremental.State(spark, root)
    assert incremental._touched_before(state, ["first"], "second").count() == 0
    known = [dict(e, user_id="new", session_id="n1") for e in events(9, 5, 12, 12)]
    incremental.run_batch(spark, store(scratch, "third", known), root, "third")
    found = incremental._touched_before(state, ["first", "second"], "third")
    assert {r.event_date.day for r in found.collect()} == {3}
    execution = found._jdf.queryExecution()
    assert "event_date" in execution.optimizedPlan().toString() and "2024-01-03" in execution.optimizedPlan().toString()
    assert "PartitionFilters: [" in execution.executedPlan().toString()


@pytest.mark.parametrize("step", ["products", "funnel", "commit"])
def test_killed_batch_is_run_again(spark, scratch, monkeypatch, step):
    root = os.path.join(scratch, "root")
    first, second = store(scratch, "first", events(10, 50, 1, 4)), store(scratch, "second", events(11, 50, 3, 6))
    incremental.run_batch(spark, first, root, "first")

    class Killed(Exception):
        pass

    def killed(*args, **kwargs):
        raise Killed

    write = incremental.State.write

    def write_until(self, df, table, schema, batch_id):
        if table == step:
            raise Killed
        write(self, df, table, schema, batch_id)

    with monkeypatch.context() as m, pytest.raises(Killed):
        m.setattr(incremental.State, "write", write_until)
        m.setattr(incremental, "commit_batch", killed)
        incremental.run_batch(spark, second, root, "second")
    assert_like_one_run(spark, root, [first])  # a batch counts when it is finished
    incremental.run_batch(spark, second, root, "second")
    assert_like_one_run(spark, root, [first, second])


@pytest.mark.parametrize("finished", [1, 2])
def test_job_killed_between_its_writes(spark, scratch, monkeypatch, finished):
    """The rerun equals one clean run: nothing twice, nothing missing."""
    from sessionmetrics.plans import job

    path = store(scratch, "in", events(12, 80, 1, 5))
    clean = run_job(spark, path, os.path.join(scratch, "clean"), batch_id="a")
    out, done = os.path.join(scratch, "out"), []

    def write_some(df, target, batch_id, *rest):
        if len(done) == finished:
            raise RuntimeError("killed")
        done.append(target)
        write_batch(df, target, batch_id, *rest)

    with monkeypatch.context() as m, pytest.raises((RuntimeError, ExceptionGroup)):
        m.setattr(job, "write_batch", write_some)
        run_job(spark, path, out, batch_id="a", parallel_writes=False)
    assert committed_batches(spark, out) == []
    for _ in range(2):
        again = run_job(spark, path, out, batch_id="a")
        assert {t: rows_of(again[t]) for t in TABLES} == {t: rows_of(clean[t]) for t in TABLES}
    more = run_job(spark, path, out, batch_id="b")
    assert {t: rows_of(more[t]) for t in TABLES} == {t: sorted(rows_of(clean[t]) * 2, key=str) for t in TABLES}


def test_batches_of_a_table(spark, scratch):
    path, root = os.path.join(scratch, "root", "t"), os.path.join(scratch, "root")
    one = spark.createDataFrame([(1, "x"), (2, "y")], "a long, b string")
    write_batch(one, path, "1")
    write_batch(one.limit(0), path, "2")
    commit_batch(spark, root, "1")
    commit_batch(spark, root, "2", {"rows": 0})
    assert [b.number for b in committed_batches(spark, root)] == [0, 1]
    assert rows_of(read_batches(spark, path, one.schema, ["1", "2"])) == rows_of(one)
    assert read_batches(spark, path, one.schema, []).count() == 0
    # a batch whose rerun has no rows leaves none of the earlier try
    write_batch(one.limit(0), path, "1")
    assert read_batches(spark, path, one.schema, ["1"]).count() == 0
    for bad in ("", "../x", "a b", "_x", "a=b"):
        with pytest.raises(ValueError):
            write_batch(one, path, bad)
    with pytest.raises(ValueError):
        run_job(spark, path, root, mode="overwrite", batch_id="x")


def test_second_writer_of_a_number_fails(spark, scratch, monkeypatch):
    from sessionmetrics.sources import batches

    root = os.path.join(scratch, "root")
    commit_batch(spark, root, "a")
    monkeypatch.setattr(batches, "committed_batches", lambda *_: [])  # it did not see the first one's marker
    with pytest.raises(FileExistsError):
        commit_batch(spark, root, "b")
    monkeypatch.undo()
    assert [b.id for b in committed_batches(spark, root)] == ["a"]


def test_command_line(spark, scratch):
    path = store(scratch, "in", events(13, 30, 1, 3))
    root = os.path.join(scratch, "root")
    incremental.main(["--input", path, "--root", root, "--batch", "only"], stop_session=False)
    assert_like_one_run(spark, root, [path])

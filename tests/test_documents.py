"""Document store over plain files: batches, commits, order, limit, pruning."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from sessionmetrics.sources import documents as docs
from sessionmetrics.sources import first_documents, read_table, register_documents, write_table

FIELDS = "k long, name string, price double, at timestamp, day date"


@pytest.fixture
def store(spark, scratch):
    register_documents(spark)
    return os.path.join(scratch, "store")


def _rows(spark, n, parts=3):
    rows = spark.range(n, numPartitions=parts).select(
        F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"), (F.col("id") / 2).alias("price"),
        F.timestamp_seconds(F.col("id") * 3600).alias("at"), F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("day"),
    )
    return rows.withColumn("name", F.when(F.col("k") % 7 != 0, F.col("name")))


def _write(df, path, mode="append", **options):
    write_table(df, path, fmt=docs.FORMAT, mode=mode, options={k.replace("_", "."): str(v) for k, v in options.items()})


def test_round_trip_in_batches(spark, store):
    df = _rows(spark, 100)
    _write(df, store, batchSize=16, writeConcern_w="majority")
    (commit,) = docs.commits(store)
    # 33, 33 and 34 rows a partition
    assert [f["rows"] for f in commit["files"]] == [16, 16, 1, 16, 16, 1, 16, 16, 2]
    back = read_table(spark, store, fmt=docs.FORMAT)
    assert back.dtypes == df.dtypes
    assert back.collect() == df.collect()  # values, and the order of the written table
    ids = [r._id for r in spark.read.format(docs.FORMAT).load(store).collect()]
    assert len(set(ids)) == 100 and ids == sorted(ids)


def test_appends_follow_one_another_and_overwrite_starts_anew(spark, store):
    _write(_rows(spark, 5), store)
    _write(_rows(spark, 3), store)
    assert [r.k for r in read_table(spark, store, fmt=docs.FORMAT).collect()] == [0, 1, 2, 3, 4, 0, 1, 2]
    _write(_rows(spark, 2), store, mode="overwrite")
    assert [r.k for r in read_table(spark, store, fmt=docs.FORMAT).collect()] == [0, 1]
    assert len(docs.commits(store)) == 1


def test_own_ids_stay(spark, store):
    _write(_rows(spark, 4).withColumn("_id", F.concat(F.lit("own"), "k")), store)
    assert [r._id for r in spark.read.format(docs.FORMAT).load(store).collect()] == [f"own{i}" for i in range(4)]


def test_a_limit_opens_only_the_first_files(spark, store):
    _write(_rows(spark, 1000).orderBy(F.desc("k")), store, batchSize=50)
    reader = docs._Reader({"path": store, "limit": "70"}, None)
    assert [p.rows for p in reader.partitions()] == [50, 20]
    first = first_documents(spark, store, 70)
    assert first.rdd.getNumPartitions() == 2
    assert [r.k for r in first.collect()] == list(range(999, 929, -1))
    # the limit comes first, then the filter
    assert first.where("k < 935").count() == 5
    # the other files are not needed
    kept = {p.file for p in reader.partitions()}
    for f in docs.commits(store)[0]["files"]:
        if f["file"] not in kept:
            os.remove(os.path.join(store, f["file"]))
    assert first_documents(spark, store, 70).count() == 70
    assert first_documents(spark, store, 0).count() == 0


def test_comparisons_skip_files(spark, store):
    _write(_rows(spark, 1000, parts=1), store, batchSize=100)
    table = read_table(spark, store, fmt=docs.FORMAT)
    for condition, files in (("k = 250", 1), ("k > 749", 3), ("k <= 99", 1), ("price >= 450", 1), ("name = 'n5'", None)):
        found = table.where(condition)
        assert found.collect() == _rows(spark, 1000).where(condition).collect()
        if files is not None:
            assert found.rdd.getNumPartitions() == files
    assert table.where("k = 5000").collect() == []


def test_nan_and_null_columns_keep_their_rows(spark, store):
    df = spark.createDataFrame([(1, float("nan"), None), (2, 1.0, None), (3, None, None)], "k long, x double, s string")
    _write(df, store)
    table = read_table(spark, store, fmt=docs.FORMAT)
    assert [r.k for r in table.where("x > 5").collect()] == [1]  # NaN is above every number
    assert table.where("s = 'a'").collect() == []
    assert [r.k for r in table.where("s is null").orderBy("k").collect()] == [1, 2, 3]


def test_a_failed_job_leaves_nothing_to_read(spark, store):
    _write(_rows(spark, 5), store)
    broken = _rows(spark, 100).withColumn("price", F.when(F.col("k") == 99, F.raise_error(F.lit("no"))).otherwise(1.0))
    with pytest.raises(Exception, match="no"):
        _write(broken, store, batchSize=10)
    assert read_table(spark, store, fmt=docs.FORMAT).count() == 5
    # files without a commit, as of a killed driver, do not count either
    with open(os.path.join(store, "batches", "left.parquet"), "w") as f:
        f.write("half")
    with open(os.path.join(store, "_commits", "000000000002.json.dead"), "w") as f:
        f.write(json.dumps({})[:1])
    assert read_table(spark, store, fmt=docs.FORMAT).count() == 5


def test_a_commit_number_is_taken_once(spark, store):
    """Two writers that saw the same commits: the second one fails."""
    schema = _rows(spark, 1).schema
    writers = [docs._Writer({"path": store}, type(schema)(list(schema.fields)), False) for _ in range(2)]
    writers[0].commit([])
    before = docs.commits
    try:
        docs.commits = lambda path: []
        with pytest.raises(OSError, match="another writer"):
            writers[1].commit([])
    finally:
        docs.commits = before


def test_refusals(spark, store):
    for options in ({"batchSize": 0}, {"writeConcern_w": 0}, {"writeConcern_w": "some"}):
        with pytest.raises(Exception, match="have to be 1 or more"):
            _write(_rows(spark, 1), store, **options)
    with pytest.raises(Exception, match="needs a schema"):
        spark.read.format(docs.FORMAT).load(store)
    _write(_rows(spark, 2), store)
    with pytest.raises(Exception, match="other columns"):
        _write(_rows(spark, 2).drop("price"), store)
    assert read_table(spark, store, fmt=docs.FORMAT).count() == 2


def test_empty_tables(spark, store):
    _write(_rows(spark, 0), store)
    assert read_table(spark, store, fmt=docs.FORMAT).collect() == []
    assert spark.read.schema(FIELDS).format(docs.FORMAT).load(store + "-none").collect() == []
    _write(spark.createDataFrame([Row(k=1)]), store + "-one")
    assert read_table(spark, store + "-one", fmt=docs.FORMAT).collect() == [Row(k=1)]

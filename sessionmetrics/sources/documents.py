"""S2/S3 sink options over plain files: a document store's append with a batch
size, an order and acknowledged writes, and its read with a limit.

``document_files`` is a Spark data source.  Tasks write their rows in batches of
at most ``batchSize``, one Parquet file each, under names no other attempt uses;
a commit record, written last by the driver, names the files that count with
their rows and the ranges of their columns.  A task that is lost or runs twice,
or a job that fails, leaves nothing that a reader sees.

Documents have an order: commits one after the other, within a commit the
partitions of the written DataFrame, within a partition its rows.  A table
written in sorted order is therefore stored sorted, and its first rows are the
first rows of its first files.

Write options: ``batchSize`` (512), ``writeConcern.w`` (``1``: a batch counts when
its file is closed; ``majority`` or more: when its footer has been read back and
holds the batch's rows; ``0``, never acknowledged, is refused).  Rows
without an ``_id`` column get one, unique in the store.

Read options: ``limit``, the first so many documents; the reader plans only the
files that hold them.  Without a limit, comparisons of columns with values skip
files whose ranges cannot match; Spark checks the rows.

A path nothing was committed to is an empty store and needs a schema to be read.
All commits of a store have the same columns.  One writer at a time commits to
a path.  Paths are those pyarrow's file systems reach (local or shared folders,
HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql.types import StringType, StructType

FORMAT = "document_files"
BATCH_SIZE = 512
_COMMITS, _BATCHES = "_commits", "batches"
#: Types whose smallest and largest value a commit records for each file.
_RANGED = (bool, int, float, str)


def _located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of ``path`` and its place there."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def commits(path: str) -> list[dict]:
    """The commits that count, oldest first; the last one that replaced the
    store's documents starts anew."""
    system, root = _located(path)
    listed = system.get_file_info(pafs.FileSelector(f"{root}/{_COMMITS}", allow_not_found=True))
    found: list[dict] = []
    for info in sorted((i for i in listed if i.path.endswith(".json")), key=lambda i: i.path):
        with system.open_input_stream(info.path) as stream:
            record = json.loads(stream.read())
        found = [record] if record["replaces"] else [*found, record]
    return found


@dataclass
class Written(D.WriterCommitMessage):
    """The batches of one task, in order."""

    partition: int
    files: list[dict]


@dataclass
class FilePart(D.InputPartition):
    """A file and how many of its first rows to read."""

    file: str
    rows: int


def _ranges(batch: pa.Table) -> dict[str, list]:
    """Smallest and largest value of each column that has such values; columns
    with a NaN have no range."""
    out = {}
    for name in batch.column_names:
        kind = batch.schema.field(name).type
        if not (pa.types.is_integer(kind) or pa.types.is_string(kind) or pa.types.is_floating(kind)):
            continue
        column = batch.column(name)
        if pa.types.is_floating(kind) and pc.any(pc.is_nan(column)).as_py():
            continue
        ends = pc.min_max(column)
        out[name] = [ends["min"].as_py(), ends["max"].as_py()]  # null, null: no value at all
    return out


class _Writer(D.DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType, replaces: bool):
        self.path = options["path"]
        self.size = int(options.get("batchsize", BATCH_SIZE))
        concern = options.get("writeconcern.w", "1")
        if self.size < 1 or not (concern == "majority" or concern.isdigit() and int(concern) >= 1):
            raise ValueError(f"batchSize {self.size} and writeConcern.w {concern}: both have to be 1 or more")
        self.checked = concern != "1"
        self.replaces, self.run = replaces, uuid.uuid4().hex
        self.names_ids = "_id" not in schema.names
        self.schema = schema.add("_id", StringType()) if self.names_ids else schema

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        partition, attempt = context.partitionId(), context.taskAttemptId()
        system, root = _located(self.path)
        system.create_dir(f"{root}/{_BATCHES}")
        files: list[dict] = []
        held: list[pa.Table] = []
        n_held = n_written = 0

        def store(rows: pa.Table) -> None:
            nonlocal n_written
            if self.names_ids:
                ids = [f"{self.run}-{partition:07d}-{n_written + i:012d}" for i in range(rows.num_rows)]
                rows = rows.append_column("_id", pa.array(ids, pa.string()))
            name = f"{_BATCHES}/{self.run}-{partition:07d}-{attempt}-{len(files):07d}.parquet"
            pq.write_table(rows, f"{root}/{name}", filesystem=system, compression="zstd")
            if self.checked and pq.read_metadata(f"{root}/{name}", filesystem=system).num_rows != rows.num_rows:
                raise OSError(f"{name} does not hold its {rows.num_rows} rows")
            files.append({"file": name, "rows": rows.num_rows, "ranges": _ranges(rows)})
            n_written += rows.num_rows

        for batch in iterator:
            held.append(pa.Table.from_batches([batch]))
            n_held += batch.num_rows
            if n_held >= self.size:
                rows, at = pa.concat_tables(held), 0
                while n_held - at >= self.size:
                    store(rows.slice(at, self.size))
                    at += self.size
                held, n_held = [rows.slice(at)], n_held - at
        if n_held:
            store(pa.concat_tables(held))
        return Written(partition, files)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _located(self.path)
        before = commits(self.path)
        names = [f.name for f in self.schema.fields]
        if before and not self.replaces and names != [f["name"] for f in before[-1]["schema"]["fields"]]:
            self.abort(messages)
            raise ValueError(f"the store has other columns than {names}")
        number = 1 + max((c["number"] for c in before), default=0)
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
        record = {
            "number": number, "run": self.run, "replaces": self.replaces, "schema": self.schema.jsonValue(),
            "batch_size": self.size, "files": [f for m in parts for f in m.files],
        }
        # written aside and moved: a record is there as a whole or not at all
        target = f"{root}/{_COMMITS}/{number:012d}.json"
        if system.get_file_info(target).type != pafs.FileType.NotFound:
            raise OSError(f"commit {number} of {self.path} was made by another writer")
        system.create_dir(f"{root}/{_COMMITS}")
        with system.open_output_stream(f"{target}.{self.run}") as stream:
            stream.write(json.dumps(record).encode())
        system.move(f"{target}.{self.run}", target)

    def abort(self, messages: list[Written | None]) -> None:
        system, root = _located(self.path)
        for file in (f["file"] for m in messages if m is not None for f in m.files):
            system.delete_file(f"{root}/{file}")


def _may_hold(ranges: dict[str, list], asked: D.Filter) -> bool:
    """False only if no row of a file with such ``ranges`` passes the filter."""
    column, value = ".".join(asked.attribute), asked.value
    if column not in ranges:
        return True
    low, high = ranges[column]
    if low is None:  # nulls alone compare with nothing
        return False
    if (isinstance(value, str) != isinstance(low, str)) or value != value:
        return True
    if isinstance(asked, D.EqualTo):
        return low <= value <= high
    if isinstance(asked, (D.GreaterThan, D.GreaterThanOrEqual)):
        return high >= value
    return low <= value


class _Reader(D.DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.schema = options["path"], schema
        self.limit = int(options["limit"]) if "limit" in options else None
        self.asked: list[D.Filter] = []

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        kinds = (D.EqualTo, D.GreaterThan, D.GreaterThanOrEqual, D.LessThan, D.LessThanOrEqual)
        for asked in filters:
            if self.limit is None and isinstance(asked, kinds) and isinstance(asked.value, _RANGED):
                self.asked.append(asked)
            yield asked  # files are skipped by it, rows are Spark's to check

    def partitions(self) -> list[FilePart]:
        parts, left = [], self.limit
        for file in (f for c in commits(self.path) for f in c["files"]):
            if left is not None and left <= 0:
                break
            if all(_may_hold(file["ranges"], asked) for asked in self.asked):
                parts.append(FilePart(file["file"], file["rows"] if left is None else min(left, file["rows"])))
            left = None if left is None else left - file["rows"]
        return parts or [FilePart("", 0)]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        if partition.rows:
            system, root = _located(self.path)
            rows = pq.read_table(f"{root}/{partition.file}", filesystem=system, columns=self.schema.names)
            yield from rows.slice(0, partition.rows).to_batches()


class DocumentFiles(D.DataSource):
    """The data source, see the module."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        known = commits(self.options["path"])
        if not known:
            raise ValueError(f"nothing was committed to {self.options['path']}: reading it needs a schema")
        return StructType.fromJson(known[-1]["schema"])

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options, StructType(list(schema.fields)), overwrite)


def register_documents(spark: SparkSession) -> None:
    """Make the format known to the session, and let filters reach its reader.
    Executors get the source with the plan, so they need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(DocumentFiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def first_documents(spark: SparkSession, path: str, limit: int) -> DataFrame:
    """The first ``limit`` documents of a store, in its order, without ``_id``."""
    register_documents(spark)
    return spark.read.format(FORMAT).option("limit", str(limit)).load(path).drop("_id")

"""Append once per batch id, however often a batch is run.

Rows of a batch go to the partition ``_batch=<id>`` of each table.  Spark
writes them to a staging folder of the job and moves whole partitions into
place when all tasks are done (dynamic partition overwrite), so a batch that
is run again replaces its own rows and no others.  A batch counts from the
moment its marker is there: one small file per batch in ``<root>/_batches``,
created under its number only if that number is free.  What a killed run has
written before is in no marker and is replaced by the rerun.

One writer at a time commits to a root; a second one that took the same
number fails instead of overwriting the first.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import create_text, list_names, path_exists, read_text, remove_path

BATCH = "_batch"
_FOLDER = "_batches"
_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


@dataclass(frozen=True)
class Batch:
    """A committed batch: its place in the order, its id, and what the writer
    noted about it."""

    number: int
    id: str
    note: dict = field(default_factory=dict, compare=False)


def check_batch_id(batch_id: str) -> str:
    """Ids name folders, so they are letters, digits, ``_``, ``.`` and ``-``."""
    if not _ID.fullmatch(batch_id):
        raise ValueError(f"not a batch id: {batch_id!r}")
    return batch_id


def write_batch(df: DataFrame, path: str, batch_id: str, partition_by: Sequence[str] = ()) -> None:
    """Write the rows of a batch, in place of what an earlier try left."""
    check_batch_id(batch_id)
    remove_path(df.sparkSession, f"{path}/{BATCH}={batch_id}")  # also if no row comes in its place
    (
        df.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH, *partition_by).parquet(path)
    )


def commit_batch(spark: SparkSession, root: str, batch_id: str, note: dict | None = None) -> Batch:
    """Make a batch count.  Raises if another writer took its number."""
    known = committed_batches(spark, root)
    batch = Batch(len(known), check_batch_id(batch_id), dict(note or {}))
    body = json.dumps({"id": batch.id, "note": batch.note})
    create_text(spark, f"{root}/{_FOLDER}/{batch.number:09d}.json", body)
    return batch


def committed_batches(spark: SparkSession, root: str) -> list[Batch]:
    """The batches that count, in the order in which they were committed."""
    folder = f"{root}/{_FOLDER}"
    out = []
    for name in sorted(n for n in list_names(spark, folder) if n.endswith(".json")):
        body = json.loads(read_text(spark, f"{folder}/{name}"))
        out.append(Batch(int(name.split(".")[0]), body["id"], body["note"]))
    return out


def read_batches(
    spark: SparkSession, path: str, schema: StructType, batch_ids: Sequence[str], partition_by: Sequence[str] = ()
) -> DataFrame:
    """The rows of some batches: only their folders are read.  The schema is
    given, as a batch without rows leaves no file to take it from; columns of
    ``partition_by`` come from folder names."""
    if not batch_ids or not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    stored = StructType([*schema.fields, StructField(BATCH, StringType())])
    rows = spark.read.schema(stored).parquet(path)
    return rows.where(F.col(BATCH).isin(*batch_ids)).select(*schema.names)

"""Intermediate tables in the cluster's shared folder.

Every intermediate result that later stages read is written below
``spark.checkpoint.dir`` (never a machine-local folder on a cluster), so a
lost executor costs a re-read and not a recomputation.  Folders are removed
when the application ends; within ``owned`` they are known and can be removed
earlier, once the results that read them are written.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import remove_path, scratch_path

_OWNERS = threading.local()


class Owned:
    """Folders and tables made while a block ran."""

    def __init__(self) -> None:
        self.paths: list[str] = []
        self.tables: list[str] = []

    def remove(self, spark: SparkSession) -> None:
        for table in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in self.paths:
            remove_path(spark, path)


@contextmanager
def owned() -> Iterator[Owned]:
    """What this thread makes within the block belongs to the result."""
    stack = _OWNERS.__dict__.setdefault("stack", [])
    stack.append(Owned())
    try:
        yield stack[-1]
    finally:
        stack.pop()


def fresh_dir(spark: SparkSession, name: str, table: str | None = None) -> str:
    """A unique folder below the shared one, for the table of that name if given."""
    path = scratch_path(spark, name)
    for owner in _OWNERS.__dict__.get("stack", [])[-1:]:
        owner.paths.append(path)
        owner.tables += [table] if table else []
    return path


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage is cut."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)

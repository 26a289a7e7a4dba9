"""Metric-table sink, read-back and reuse cache.

The sink is format-agnostic: parquet by default, any other data source by
name with its options passed through (a document-store connector, for
instance, when its jar is on the classpath).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession


def write_table(
    df: DataFrame,
    path: str | None = None,
    fmt: str = "parquet",
    mode: str = "append",
    options: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Write ``df``.  Append (the original job's mode) adds a second copy
    of every row on a rerun; use ``mode="overwrite"`` for idempotent runs."""
    writer = df.write.format(fmt).mode(mode).options(**dict(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is None:
        writer.save()
    else:
        writer.save(path)


def read_table(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    drop: Sequence[str] = ("_id",),
    limit: int | None = None,
    order_by: Sequence[Column | str] = (),
) -> DataFrame:
    """S3: read a stored table back and drop store-added columns (``_id``).
    ``limit`` keeps the first rows under ``order_by``, which it requires: an
    unordered cut would keep arbitrary rows."""
    if limit is not None and not order_by:
        raise ValueError("limit needs order_by")
    reader = spark.read.format(fmt).options(**dict(options or {}))
    df = reader.load(path) if path is not None else reader.load()
    present = [c for c in drop if c in df.columns]
    if present:
        df = df.drop(*present)
    if order_by:
        df = df.orderBy(*order_by)
    if limit is not None:
        df = df.limit(limit)
    return df


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` for the actions of a block and release it afterwards,
    also when one of them fails."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()

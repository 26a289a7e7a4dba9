"""Vector columns as packed bytes, and distinct vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import column_bytes


def is_usable(column: str):
    """Neither null, empty nor zero, and all components finite."""
    c = F.col(column)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(c, lambda x: x != 0), F.lit(False))


def value_type(df: DataFrame, column: str) -> str:
    """numpy type that holds the column's components exactly."""
    element = df.schema[column].dataType.elementType
    return "f4" if isinstance(element, T.FloatType) else "f8"


def packed(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, np.dtype, int]:
    """(id, vec) of the usable rows with an id, their type and dimension.
    Shorter vectors are filled up with zeros to the longest."""
    kind = np.dtype(value_type(df, vector_col))
    element = "float" if kind.itemsize == 4 else "double"
    good = df.where(F.col(id_col).isNotNull() & is_usable(vector_col)).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{element}>").alias("v")
    )
    dim = int(good.select(F.max(F.size("v"))).first()[0] or 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            sizes = v.value_lengths().to_numpy(zero_copy_only=False)
            flat = v.flatten().to_numpy(zero_copy_only=False)
            out = np.zeros((len(batch), dim), kind)
            out[np.repeat(np.arange(len(batch)), sizes), np.concatenate([np.arange(n) for n in sizes] or [[]]).astype(int)] = flat
            out += 0.0  # one zero: -0.0 equals 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in out], pa.binary())], names=["id", "vec"]
            )

    return good.mapInArrow(run, "id long, vec binary"), kind, dim


def matrix(column: pa.Array, kind: np.dtype, dim: int) -> np.ndarray:
    """The vectors of a packed column."""
    return np.frombuffer(b"".join(column_bytes(column)), kind).reshape(-1, dim)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, orthonormal; the width is a power of two."""
    n, width, h = x.shape[0], x.shape[1], 1
    while h < width:
        x = x.reshape(n, -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, width) / np.sqrt(width)

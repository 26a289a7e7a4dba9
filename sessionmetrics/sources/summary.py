"""What a writer saw of a table, kept beside it.

While the rows are written, Spark's observed metrics count them and keep the
first row; ``_summary.json`` in the table's folder holds both with the
columns and the names and sizes of the data files.  A report takes them from
there and scans nothing.  A summary whose files are not exactly those in the
folder (something was appended, replaced or removed since) does not count.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import create_text, file_sizes, path_exists, read_text, remove_path

_NAME = "_summary.json"
#: Formats that keep a table as files in its folder.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")


@dataclass(frozen=True)
class Summary:
    """Rows, columns and first row (by all columns in order, as JSON) of a table."""

    row_count: int
    columns: tuple[str, ...]
    first: str | None


def write_summarised(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append", options: Mapping[str, str] | None = None
) -> Summary | None:
    """Write ``df`` and keep its summary.  Rows appended to others are not
    summed up (None), nor is what goes to no file: a report counts such a
    table."""
    spark = df.sparkSession
    alone = fmt in FILE_FORMATS and (mode == "overwrite" or (mode != "ignore" and not file_sizes(spark, path)))
    seen = Observation()
    count, first = F.count(F.lit(1)).alias("row_count"), F.to_json(F.min(F.struct(*df.columns))).alias("first")
    watched = df.observe(seen, count, first) if alone else df
    watched.write.format(fmt).mode(mode).options(**dict(options or {})).save(path)
    if fmt in FILE_FORMATS and mode != "ignore" and path_exists(spark, f"{path}/{_NAME}"):
        remove_path(spark, f"{path}/{_NAME}")
    if not alone:
        return None
    summary = Summary(seen.get["row_count"], tuple(df.columns), seen.get["first"])
    body = {"summary": asdict(summary), "files": file_sizes(spark, path)}
    create_text(spark, f"{path}/{_NAME}", json.dumps(body))
    return summary


def read_summary(spark: SparkSession, path: str) -> Summary | None:
    """The summary of the table at ``path``, if it is that of its files."""
    if not path_exists(spark, f"{path}/{_NAME}"):
        return None
    body = json.loads(read_text(spark, f"{path}/{_NAME}"))
    if body["files"] != file_sizes(spark, path):
        return None
    kept = body["summary"]
    return Summary(kept["row_count"], tuple(kept["columns"]), kept["first"])

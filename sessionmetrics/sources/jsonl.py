"""JSON-lines events in and out.

The reader is line-delimited (splittable when uncompressed or bzip2), takes
the fixed schema (no inference pass over the input) and is PERMISSIVE: a
malformed line or a wrong-typed field yields nulls that the cleanse filter
then drops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schema import RAW_SCHEMA


def read_raw_events(
    spark: SparkSession, path: str | list[str], schema: StructType = RAW_SCHEMA
) -> DataFrame:
    """Read JSON-lines files (path, glob or list) with the raw schema."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


_LINE = "_corrupt_record"


def split_malformed(
    spark: SparkSession, path: str | list[str], target: str, schema: StructType = RAW_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """S1 with a second output: (events, lines that do not fit the schema).

    One pass over the text writes both parts to ``target``, so that neither is
    parsed again.  ``line`` is the whole raw text of a line that is no JSON or
    has a value of another type.  ``read_raw_events`` turns such a line into a
    row with nulls, which the cleanse drops if it lacks anything it needs; here
    it is no event, and its text is kept."""
    lines = spark.read.schema(StructType([*schema.fields, StructField(_LINE, StringType())]))
    lines = lines.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).json(path)
    marked = lines.withColumn("malformed", F.col(_LINE).isNotNull())
    marked.write.mode("overwrite").partitionBy("malformed").parquet(target)
    stored = StructType([*lines.schema.fields, StructField("malformed", StringType())])
    both = spark.read.schema(stored).parquet(target)
    events = both.where(F.col("malformed") == "false").select(*schema.names)
    return events, both.where(F.col("malformed") == "true").select(F.col(_LINE).alias("line"))


def write_jsonl(
    df: DataFrame,
    path: str,
    records_per_file: int | None = None,
    mode: str = "errorifexists",
    compression: str | None = None,
) -> None:
    """Write all rows as JSON lines, at most ``records_per_file`` per file."""
    writer = df.write.mode(mode)
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", int(records_per_file))
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)

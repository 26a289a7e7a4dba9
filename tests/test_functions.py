"""Scalar helpers F1, F3, F9, F10, F11 on edge values."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionmetrics.functions import (
    epoch_seconds,
    is_time_only,
    lenient_number,
    parse_timestamp,
    product_label,
    safe_ratio,
)


def test_product_label(spark):
    rows = [("books", "p1"), (None, "p1"), ("books", None), (" • books", "p1 • "), ("", "p2")]
    df = spark.createDataFrame(rows, "category string, product string")
    got = [r.l for r in df.select(product_label(F.col("category"), F.col("product")).alias("l")).collect()]
    assert got == ["books • p1", "p1", "books", "books • p1", "p2"]


def test_lenient_number(spark):
    df = spark.createDataFrame([("12",), ("3.5",), ("abc",), (None,), (" 7 ",), ("NaN",)], "v string")
    got = [r.n for r in df.select(lenient_number(F.col("v")).alias("n")).collect()]
    assert got == [12.0, 3.5, 0.0, 0.0, 7.0, 0.0]
    df = spark.createDataFrame([(float("nan"),), (2.5,)], "v double")
    assert [r.n for r in df.select(lenient_number(F.col("v")).alias("n")).collect()] == [0.0, 2.5]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 2), (3, 0), (5, -1), (None, 4)], "n long, d long")
    got = [r.r for r in df.select(safe_ratio(F.col("n"), F.col("d")).alias("r")).collect()]
    assert got[:3] == [0.5, 0.0, 0.0] and got[3] is None


def test_epoch_seconds_floors(spark):
    df = spark.createDataFrame(
        [("2024-01-01T00:00:00.999Z",), ("1969-12-31T23:59:59.5Z",)], "t string"
    )
    got = [r.s for r in df.select(epoch_seconds(parse_timestamp(F.col("t"))).alias("s")).collect()]
    assert got == [1704067200, -1]  # floor, also before 1970


def test_parse_timestamp_forms(spark):
    texts = ["2024-01-01", "2024-01-01 10:00", "2024-01-01T10:00:00+02:00", "  2024-01-01T10:00:00Z  ",
             "12:30", "T12:30", "2024-1-1", "nope", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.s for r in df.select(parse_timestamp(F.col("t")).cast("string").alias("s")).collect()]
    assert got == ["2024-01-01 00:00:00", "2024-01-01 10:00:00", "2024-01-01 08:00:00",
                   "2024-01-01 10:00:00", None, None, "2024-01-01 00:00:00", None, None]
    flags = [r.t for r in df.select(is_time_only(F.col("t")).alias("t")).collect()]
    assert [t for t, only in zip(texts, flags) if only] == ["12:30", "T12:30"]
    loose = [r.s for r in df.select(parse_timestamp(F.col("t"), require_date=False).alias("s")).collect()]
    assert loose[4] is not None and loose[7] is None

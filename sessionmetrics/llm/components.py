"""Connected components of a graph given as an edge table.

Alternating large-star and small-star steps: each node hands its larger
neighbours, then its smaller ones, to the smallest node it knows.  Edges only
ever shrink to stars, so a few rounds suffice; every round is written to the
shared folder.  Links are joined and aggregated by Spark, never collected; a
node with very many links is a skewed join key that adaptive execution splits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch


def _apart(df: DataFrame) -> DataFrame:
    """An aggregate dealt anew, so that a join with it reads two plain
    exchanges: only then can adaptive execution split a hub's partition."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.where(F.col("b") > F.col("a")).join(_apart(least), "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    # a > b in every edge here
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(_apart(least), "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) -> (node, root), one row per node that has an
    edge to another node; root is the smallest node of its component."""
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    edges = scratch.written(edges, "edges")

    def state(e: DataFrame) -> tuple:
        h = F.xxhash64("a", "b")
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(h)).first())

    now = state(edges)
    while True:
        last = now
        edges = scratch.written(_small_star(_large_star(edges)), "edges")
        now = state(edges)
        if now == last:
            break
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def local_stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of the component of each of the nodes 0..n-1."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root

"""Embedding near-duplicates by cross-polytope hashing.

A table hashes a vector ``parts`` times: a pseudo-random rotation (three
rounds of sign flips and a fast Hadamard transform), then the nearest of the
``2 * width`` signed axes.  The axes together name the home bucket; a vector
is also sent to the next ``probes - 1`` buckets, in the order of how much
farther their axes are (multiprobe).  In every bucket the vectors at home are
compared with all that came, by cosine in double precision.

Equal vectors are one row with a multiplicity, so a vector that a third of
all rows share costs one row.  Every row carries all its buckets: a pair that
meets several times counts where it meets first, so links are counted without
gathering pairs.  Crowded buckets are cut into a grid of cells.

Nulls and edges: vectors that are null, empty, zero or hold null or
non-finite components link with nothing and are their own component; shorter
vectors are taken as filled up with zeros; rows whose id is null are left
out; repeated rows link with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grid, scratch
from .blocks import column_bytes
from .components import components, local_stars
from .text import U, mix
from .vectors import hadamard, matrix, packed

COSINE = 0.9
#: Of pairs at cosine 0.9 in 64 dimensions, 6 tables miss some 0.4 %.
TABLES, PARTS, PROBES = 12, 2, 4
_PER_PART = 4
_BATCH, _PAIRS = 1 << 13, 1 << 16


class Hashing:
    """Buckets of vectors in every table."""

    def __init__(self, dim: int, tables: int, parts: int, probes: int, seed: int):
        self.width = 1 << max(1, (dim - 1).bit_length())
        self.tables, self.parts, self.probes = tables, parts, min(probes, _PER_PART**parts)
        rng = np.random.default_rng(seed)
        self.signs = rng.choice([-1.0, 1.0], (tables, parts, 3, self.width))

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables, probes) bucket numbers; probe 0 is the home."""
        full = np.zeros((len(x), self.width))
        full[:, : x.shape[1]] = x
        out = np.zeros((len(x), self.tables, self.probes), U)
        for t in range(self.tables):
            key, far = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
            for p in range(self.parts):
                y = full
                for sign in self.signs[t, p]:
                    y = hadamard(y * sign)
                both = np.concatenate([y, -y], axis=1)
                near = np.argsort(-both, axis=1, kind="stable")[:, :_PER_PART]
                value = np.take_along_axis(both, near, axis=1)
                more = (value[:, :1] - value) ** 2
                key = (key[:, :, None] * (2 * self.width) + near[:, None, :]).reshape(len(x), -1)
                far = (far[:, :, None] + more[:, None, :]).reshape(len(x), -1)
            best = np.argsort(far, axis=1, kind="stable")[:, : self.probes]
            chosen = np.take_along_axis(key, best, axis=1).astype(U)
            out[:, t] = chosen
        return out

    @property
    def kind(self) -> str:
        """A type that holds the bucket numbers of a table."""
        most = (2 * self.width) ** self.parts
        return "u2" if most <= 1 << 16 else "u4" if most <= 1 << 32 else "u8"

    def keys(self, buckets: np.ndarray, table: int) -> np.ndarray:
        """Bucket numbers as keys that differ between tables."""
        return mix(buckets * U(self.tables) + U(table))


#: Cell of the rows of buckets that are no grid: there a home is a replica too.
_WHOLE = -1


def _row_type(kind: np.dtype, dim: int, hashing: Hashing) -> np.dtype:
    return np.dtype([
        ("key", "u8"), ("cell", "i4"), ("home", "?"), ("table", "i1"), ("rep", "i8"), ("copies", "i8"),
        ("buckets", hashing.kind, (hashing.tables, hashing.probes)), ("vec", kind, (dim,)),
    ])


def _batches(batches: Iterator[pa.RecordBatch], kind: np.dtype, dim: int):
    for batch in batches:
        for lo in range(0, len(batch), _BATCH):
            part = batch.slice(lo, _BATCH)
            yield part, matrix(part.column("vec"), kind, dim)


def _first_meeting(a: np.ndarray, b: np.ndarray, table: np.ndarray, a_first: np.ndarray) -> np.ndarray:
    """Whether the meeting of home ``a`` with ``b`` in ``table`` is the first
    of the pair.  Meetings are ordered by table; in a table, that at the home
    of the smaller id comes first (``a_first``: a is the smaller)."""
    at_a = (a[:, :, :1] == b).any(axis=2)  # b came to a's home
    at_b = (b[:, :, :1] == a).any(axis=2)
    tables = np.arange(a.shape[1])
    before = ((at_a | at_b) & (tables < table[:, None])).any(axis=1)
    same = np.take_along_axis(at_b, table[:, None].astype(np.int64), axis=1)[:, 0] & ~a_first
    return ~before & ~same


def _compare(rows: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of a bucket: (vector, links counted here, root of its star)."""
    rows = rows[np.lexsort((rows["rep"], ~rows["home"], rows["cell"], rows["key"]))]
    names, node = np.unique(rows["rep"], return_inverse=True)
    key, cell, home = rows["key"], rows["cell"], rows["home"]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]))
    count = np.diff(np.append(first, len(rows)))
    homes = np.add.reduceat(home.astype(np.int64), first)
    apart = np.where(cell[first] == _WHOLE, 0, homes)  # a grid's replicas follow its homes
    # distinct vectors only: norms are not zero
    norm = np.empty(len(rows))
    for lo in range(0, len(rows), _PAIRS):
        norm[lo : lo + _PAIRS] = np.linalg.norm(rows["vec"][lo : lo + _PAIRS].astype(float), axis=1)
    n_links, root = np.zeros(len(names), np.int64), np.arange(len(names))
    for x, y in grid.pair_chunks(first, homes, first + apart, count - apart, _PAIRS):
        other = (y > x) | ~home[y]  # two homes of a bucket meet once, at the smaller id's
        x, y = x[other], y[other]
        dot = np.einsum("ij,ij->i", rows["vec"][x].astype(float), rows["vec"][y].astype(float))
        near = (dot / (norm[x] * norm[y]) >= cosine) & (node[x] != node[y])
        x, y = x[near], y[near]
        if not len(x):
            continue
        fresh = _first_meeting(rows["buckets"][x], rows["buckets"][y], rows["table"][x], rows["rep"][x] < rows["rep"][y])
        np.add.at(n_links, node[x[fresh]], rows["copies"][y[fresh]])
        np.add.at(n_links, node[y[fresh]], rows["copies"][x[fresh]])
        root = local_stars(
            len(names), np.concatenate([np.arange(len(names)), node[x]]), np.concatenate([root, node[y]])
        )
    seen = np.flatnonzero((n_links > 0) | (root != np.arange(len(names))))
    return names[seen], n_links[seen], names[root[seen]]


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
    tables: int = TABLES, parts: int = PARTS, probes: int = PROBES, seed: int = 42, cell: int = grid.CELL,
) -> DataFrame:
    """One row per vector: id, n_links, component (smallest id reachable)."""
    spark = vectors.sparkSession
    rows, kind, dim = packed(vectors, id_col, vector_col)
    rows = scratch.written(rows, "vectors")
    nodes = rows.groupBy("vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    nodes = scratch.written(nodes, "distinct-vectors")
    hashing = Hashing(dim, tables, parts, probes, seed)
    row_type = _row_type(kind, dim, hashing)
    n = nodes.count()

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _batches(batches, kind, dim):
            home = hashing.buckets(x)[:, :, 0]
            key = np.concatenate([hashing.keys(home[:, t], t) for t in range(hashing.tables)])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])

    hot = grid.crowded(nodes.select("vec").mapInArrow(homes, "key long"), n * tables, cell)
    sent = n * hashing.tables * hashing.probes * row_type.itemsize
    crowded = np.array(sorted(hot), U)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sent >> 25)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _batches(batches, kind, dim):
            places = hashing.buckets(x)
            rep = part.column("rep").to_numpy()
            copies = part.column("copies").to_numpy()
            for t in range(hashing.tables):
                key = hashing.keys(places[:, t].ravel(), t)
                who, home = np.divmod(np.arange(len(key)), hashing.probes)
                home = home == 0
                whole = np.flatnonzero(~np.isin(key, crowded))
                # in a grid a home stands once as home and once as replica
                cut = np.flatnonzero(np.isin(key, crowded))
                twice = np.concatenate([cut, cut[home[cut]]])
                as_home = np.arange(len(twice)) >= len(cut)
                copy, cell_of = grid.spread(key[twice], as_home, rep[who[twice]].astype(U), hot)
                row = np.concatenate([whole, twice[copy]])
                cell_of = np.concatenate([np.full(len(whole), _WHOLE), cell_of])
                out = np.zeros(len(row), row_type)
                i = who[row]
                out["key"], out["cell"], out["table"] = key[row], cell_of, t
                out["home"] = np.concatenate([home[whole], as_home[copy]])
                out["rep"], out["copies"], out["buckets"], out["vec"] = rep[i], copies[i], places[i], x[i]
                bucket = (mix(out["key"] ^ (cell_of.astype(U) << U(40))) % U(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                ends = [*cuts[1:], len(order)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[order][cuts], pa.int32()),
                        pa.array([out[order[a:b]].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                    ],
                    names=["bucket", "payload"],
                )

    def compare(table: pa.Table) -> pa.Table:
        got = np.frombuffer(b"".join(column_bytes(table.column("payload"))), row_type)
        a, links, b = _compare(got, cosine)
        return pa.table([pa.array(a), pa.array(links), pa.array(b)], names=["a", "n", "b"])

    found = (
        nodes.mapInArrow(replicate, "bucket int, payload binary")
        .groupBy("bucket").applyInArrow(compare, "a long, n long, b long")
    )
    found = scratch.written(found, "links")
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    roots = components(found.select("a", "b"))
    known = (
        nodes.join(counts, nodes["rep"] == counts["a"], "left")
        .join(roots, nodes["rep"] == roots["node"], "left")
        .select(
            "vec", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component"),
        )
    )
    every = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"))
    linked = rows.join(known, "vec").select("id", "n_links", "component")
    # a repeated id has the same vector or is told apart by it, so rows are
    # taken from the vectors; those that link with nothing are added
    usable = rows.select("id").distinct()
    alone = every.join(usable, "id", "left_anti").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.unionByName(alone)

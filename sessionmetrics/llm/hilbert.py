"""Nearest neighbours by inner product with shifted Hilbert curves.

Every curve projects the directions of the vectors to a few random axes, shifts
them and orders them along a Hilbert curve.  Spark sorts the rows by range into
that order and cuts it into blocks.  A query looks at a window of neighbouring
rows, of fixed size, on every curve; the windows are merged and reranked by the
exact inner product.

What the windows miss is found by bounds, not by wider windows.  The k-th best
score of the windows is a floor for the answer.  A block of the first curve
holds vectors of like directions, so their centre, their radius and the largest
norm bound every inner product in it; a query goes on to those blocks only whose
bound reaches its floor, and they send back only what reaches it too.  The
result is exact whatever the norms.  Clustered vectors leave few blocks to
search; vectors without any structure leave all of them, in blocks of queries
against blocks of rows.  ``complete=False`` stops after the windows.

Equal vectors are one row that carries its ``k + 1`` smallest ids, all that a
list of ``k`` neighbours can use; equal keys are ordered by id, so a vector
shared by a third of all rows is no crowded block.

Scores add up the products in order of the components, in double precision, so
that equal scores are equal however the rows are dealt.

Nulls and edges: vectors that are null, empty, zero or hold null or
non-finite components are neither queries nor candidates; nor are rows
without an id.  Ties go to the smaller id.  With fewer than ``k`` candidates
all are returned.  Of rows repeated with one id and vector one counts.  An empty
table gives an empty result.  Columns other than the two named are not read, so
they may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scratch
from .vectors import matrix, packed

CURVES, DIRECTIONS, BITS = 6, 4, 10
#: A query's window on a curve: the rows of its slab and of the two beside it.
SLAB_ROWS = 1024
BLOCK_ROWS, BLOCK_BYTES = 4096, 8 << 20
#: Block bounds that meet a set of queries at once, and sets that meet a block at once.
BOUNDS, SETS = 1024, 64
_BLOCK = "curve int, block long, rep binary, vec binary, asked binary, centre binary, radius double, norm double"
_FOUND = "query long, cand long, score double"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell coordinates."""
    x = cells.astype(np.int64).T.copy()
    top = 1 << (bits - 1)
    # undo the excess rotations, from the coarsest level to the finest
    level = top
    while level > 1:
        low = level - 1
        for i in range(len(x)):
            inverted = (x[i] & level) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inverted, low, swap)
            x[i] ^= swap if i else 0
        level >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    level = top
    while level > 1:
        flip ^= np.where(x[-1] & level, level - 1, 0)
        level >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(len(x)):
            key = key << 1 | (x[i] >> bit & 1)
    return key


class Curves:
    """Projection, shift and order of every curve."""

    def __init__(self, dim: int, curves: int, directions: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        directions = min(directions, dim)
        self.axes = [np.linalg.qr(rng.normal(size=(dim, directions)))[0] for _ in range(curves)]
        self.shift = rng.random((curves, directions))
        self.bits = bits

    def keys(self, unit: np.ndarray, curve: int) -> np.ndarray:
        y = unit @ self.axes[curve]  # -1..1
        cells = ((y + 1) / 2 + self.shift[curve]) / 2 * (1 << self.bits)
        return hilbert_keys(np.clip(cells.astype(np.int64), 0, (1 << self.bits) - 1), self.bits)


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and norms; squares neither overflow nor vanish."""
    largest = np.abs(x).max(axis=1, keepdims=True)
    scaled = x / largest
    length = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return scaled / length, (largest * length)[:, 0]


def _block_starts(curve: np.ndarray, rows: int) -> list[int]:
    """Where blocks of at most ``rows`` rows of one curve start."""
    cuts = np.flatnonzero(np.diff(curve, prepend=curve[:1] - 1))
    return [at for lo, hi in zip(cuts, [*cuts[1:], len(curve)]) for at in range(lo, hi, rows)]


def _best(
    query: np.ndarray, q_rep: np.ndarray, cand: np.ndarray, c_rep: np.ndarray, k: int, floor: np.ndarray | None = None
) -> list[np.ndarray]:
    """The ``k`` nearest candidates of each query whose score is no less than
    its ``floor``; ties by the smaller id."""
    order = np.argsort(c_rep, kind="stable")
    cand, c_rep = cand[order], c_rep[order]
    floor = np.full(len(query), -np.inf) if floor is None else floor
    # what a matrix product may be off by, twice over
    slack = 1e-15 * (cand.shape[1] + 2) * _directions(query)[1] * _directions(cand)[1].max()
    out = []
    for lo in range(0, len(query), 256):
        q = query[lo : lo + 256]
        rough = q @ cand.T
        border = floor[lo : lo + 256]
        if rough.shape[1] > k:
            border = np.maximum(border, -np.partition(-rough, k - 1, axis=1)[:, k - 1])
        i, j = np.nonzero(~(rough < (border - slack[lo : lo + 256])[:, None]))
        s = np.zeros(len(i))
        for d in range(cand.shape[1]):
            s += q[i, d] * cand[j, d]
        o = np.lexsort((j, -s, i))  # rows of a query together, nearest first
        i, j, s = i[o], j[o], s[o]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        top = (place < k) & ~(s < floor[lo + i])
        out.append((q_rep[lo + i[top]], c_rep[j[top]], s[top]))
    return [np.concatenate(x) for x in zip(*out)]


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query, of candidates found once or more."""
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "cand")
    merged = found.groupBy("query", "cand").agg(F.max("score").alias("score"))
    return merged.withColumn("_n", F.row_number().over(nearest)).where(F.col("_n") <= k)


class _Vectors:
    """How packed vectors are read."""

    def __init__(self, kind: np.dtype, dim: int):
        self.kind, self.dim = kind, dim

    def __call__(self, column: pa.Array) -> np.ndarray:
        return matrix(column, self.kind, self.dim).astype(float)


def _blocks(index: DataFrame, read: _Vectors, curve_set: Curves, curves: int, block_rows: int, n: int) -> DataFrame:
    """The rows in the order of every curve, a block of them in each row."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _directions(read(batch.column("vec")))[0] if len(batch) else np.zeros((0, read.dim))
            for c in range(curves):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(unit), c), pa.int32()), pa.array(curve_set.keys(unit, c)), *batch.columns],
                    names=["curve", "key", *batch.schema.names],
                )

    def block(rows: pa.Table, number: int) -> pa.RecordBatch:
        x = read(rows.column("vec"))
        unit, norm = _directions(x)
        centre = unit.mean(axis=0)
        radius = float(np.sqrt(((unit - centre) ** 2).sum(axis=1).max()))
        values = [
            rows.column("curve")[0].as_py(), number, rows.column("rep").to_numpy().tobytes(),
            x.astype(read.kind).tobytes(), rows.column("asked").to_numpy().astype(np.uint8).tobytes(),
            centre.tobytes(), radius, float(norm.max()),
        ]
        types = [pa.int32(), pa.int64(), *[pa.binary()] * 4, pa.float64(), pa.float64()]
        names = [field.split()[0] for field in _BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, open_rows = TaskContext.get().partitionId() << 32, None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if open_rows is None else pa.concat_tables([open_rows, rows])
            starts = _block_starts(rows.column("curve").to_numpy(), block_rows)
            for lo, hi in zip(starts, starts[1:]):
                yield block(rows.slice(lo, hi - lo), number)
                number += 1
            open_rows = rows.slice(starts[-1]) if starts else None
        if open_rows is not None:
            yield block(open_rows, number)

    placed = index.select("rep", "vec", "asked").mapInArrow(
        place, "curve int, key long, rep long, vec binary, asked int"
    )
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = n * curves
    parts = max(1, total // (4 * block_rows), min(tasks, total // block_rows))
    line = placed.repartitionByRange(parts, "curve", "key", "rep").sortWithinPartitions("curve", "key", "rep")
    return scratch.written(line.select("curve", "rep", "vec", "asked").mapInArrow(cut, _BLOCK), "curves")


def _windows(blocks: DataFrame, read: _Vectors, k: int, slab: int) -> DataFrame:
    """The ``k`` nearest rows in the window of every query, curve by curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                x = read(batch.column("vec").slice(i, 1))
                rep = np.frombuffer(batch.column("rep")[i].as_py(), np.int64)
                asked = np.frombuffer(batch.column("asked")[i].as_py(), np.uint8)
                for lo in range(0, len(rep), slab):
                    own = lo + np.flatnonzero(asked[lo : lo + slab])
                    if len(own):
                        near = slice(max(0, lo - slab), lo + 2 * slab)
                        found = _best(x[own], rep[own], x[near], rep[near], k)
                        yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], names=["query", "cand", "score"])

    return blocks.select("rep", "vec", "asked").mapInArrow(run, _FOUND)


def _rest(blocks: DataFrame, best: DataFrame, read: _Vectors, k: int) -> DataFrame:
    """Candidates that reach a query's floor in the blocks whose bound does."""
    first = blocks.where(F.col("curve") == 0)
    n_blocks = first.count()

    def queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                x = read(batch.column("vec").slice(i, 1)).astype(read.kind)
                rep = np.frombuffer(batch.column("rep")[i].as_py(), np.int64)
                own = np.flatnonzero(np.frombuffer(batch.column("asked")[i].as_py(), np.uint8))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(own), batch.column("block")[i].as_py())), pa.array(rep[own]),
                        pa.array([r.tobytes() for r in x[own]], pa.binary()),
                    ],
                    names=["of", "query", "vec"],
                )

    floors = best.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
    asked = first.select("block", "rep", "vec", "asked").mapInArrow(queries, "of long, query long, vec binary")
    # the queries of one block are one set: they look alike, and it is no larger than a block
    sets = asked.join(floors, "query").groupBy("of").agg(
        F.collect_list(F.struct("query", "vec", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))).alias("asked")
    )
    packs = -(-n_blocks // BOUNDS) or 1
    bounds = first.withColumn("pack", F.pmod(F.xxhash64("block"), F.lit(packs))).groupBy("pack").agg(
        F.collect_list(F.struct("block", "centre", "radius", "norm")).alias("bounds")
    )

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                query, vec, floor = batch.column("asked").slice(i, 1).flatten().flatten()
                block, centre, radius, norm = batch.column("bounds").slice(i, 1).flatten().flatten()
                unit, length = _directions(read(vec))
                norm = norm.to_numpy()
                angle = unit @ matrix(centre, np.dtype("f8"), read.dim).T + radius.to_numpy()
                bound = length[:, None] * norm * (np.maximum(angle, 0) + 1e-9)
                go = ~(bound < floor.to_numpy()[:, None])
                for b in np.flatnonzero(go.any(axis=0)):
                    rows = pa.array(np.flatnonzero(go[:, b]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block[b].as_py()]), batch.column("of").slice(i, 1),
                            *(pa.array([c.take(rows).to_numpy().tobytes()], pa.binary()) for c in (query, floor)),
                            pa.array([b"".join(vec.take(rows).to_pylist())], pa.binary()),
                        ],
                        names=["block", "of", "query", "floor", "vec"],
                    )

    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(packs - 1).cast("long")))
    pairs = sets.withColumn("pack", every).join(bounds, "pack").select("of", "asked", "bounds")
    pairs = pairs.mapInArrow(reached, "block long, of long, query binary, floor binary, vec binary")
    deal = F.pmod(F.xxhash64("of"), F.lit(-(-n_blocks // SETS) or 1)).alias("share")
    pairs = scratch.written(pairs.select("block", deal, "query", "floor", "vec"), "blocks-to-search")
    needed = pairs.select("block", "share").distinct().toDF("block", "for_share")
    rows = first.select("block", F.col("rep"), "vec").join(needed, "block")

    def search_block(left: pa.Table, right: pa.Table) -> pa.Table:
        cand, c_rep = read(right.column("vec")), np.frombuffer(right.column("rep")[0].as_py(), np.int64)
        found = [
            _best(
                read(left.column("vec").slice(i, 1)), np.frombuffer(left.column("query")[i].as_py(), np.int64),
                cand, c_rep, k, np.frombuffer(left.column("floor")[i].as_py(), float),
            )
            for i in range(left.num_rows)
        ]
        return pa.table([pa.array(np.concatenate(f)) for f in zip(*found)], names=["query", "cand", "score"])

    return (
        pairs.groupBy("block", "share").cogroup(rows.groupBy("block", "for_share")).applyInArrow(search_block, _FOUND)
    )


def search(
    vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
    curves: int = CURVES, directions: int = DIRECTIONS, bits: int = BITS, slab_rows: int = SLAB_ROWS,
    block_rows: int = BLOCK_ROWS, seed: int = 42, complete: bool = True,
) -> DataFrame:
    """(query, rank, id, score): each query's ``k`` nearest other rows.
    ``is_query`` is a condition on a column ``id``."""
    rows, kind, dim = packed(vectors, id_col, vector_col)
    rows = scratch.written(rows.distinct(), "vectors")
    few = rows.withColumn("_n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("_n") <= k + 1)
    ids = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = rows.groupBy("vec").agg(F.max(is_query.cast("int")).alias("asked"))
    index = scratch.written(
        ids.join(asked, "vec").select(F.col("ids")[0].alias("rep"), "vec", "ids", "asked"), "distinct-vectors"
    )
    read = _Vectors(kind, dim)
    block_rows = min(block_rows, max(64, BLOCK_BYTES // (dim * kind.itemsize)))
    blocks = _blocks(index, read, Curves(dim, curves, directions, bits, seed), curves, block_rows, index.count())
    # k + 1 distinct vectors, the query's own among them, hold k other rows
    near = scratch.written(_top(_windows(blocks, read, k + 1, slab_rows), k + 1).drop("_n"), "windows")
    if complete:
        near = _top(near.unionByName(_rest(blocks, near, read, k + 1)), k + 1)
    spelled = near.join(index.select(F.col("rep").alias("cand"), "ids"), "cand").select(
        "query", F.explode("ids").alias("id"), "score"
    )
    own = rows.where(is_query).join(index.select(F.col("rep").alias("_rep"), "vec"), "vec").select("_rep", F.col("id").alias("_query"))
    rank = Window.partitionBy("_query").orderBy(F.desc("score"), "id")
    return (
        own.join(spelled, F.col("_rep") == F.col("query")).where(F.col("id") != F.col("_query"))
        .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
        .select(F.col("_query").alias("query"), "rank", "id", "score")
    )

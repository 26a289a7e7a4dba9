"""SimHash near-duplicates by anchor-point covering.

Fingerprints within ``distance`` bits are linked.  The 64 bits are cut into
two halves; two linked fingerprints differ in at most ``distance // 2`` bits
of one half.  Each half has a covering code, the product of small perfect
codes, whose codewords are the anchors: a fingerprint's home is the nearest
anchor, and it is replicated to every anchor within the covering radius plus
the threshold, the excess over each factor's radius adding up to at most the
threshold.  If x and y differ in t bits of a half, y is replicated to x's
home; so comparing homes with replicas, anchor by anchor, misses no link.

Equal fingerprints are one node from the start.  Within an anchor the links
found become a star per component, so a group of copies yields as many rows
as it has members, not pairs.  Anchors that are home to very many
fingerprints are cut into a grid of cells that are compared one by one.

Nulls and edges: a null or wordless text has fingerprint zero and is linked
like any other; a row whose id is null is left out; repeated rows are linked
to each other; the words of a text shorter than a shingle are one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grid, scratch
from .blocks import column_bytes, split, unpack
from .components import components, local_stars
from .text import U, mix, ranges

SHINGLE = 4
DISTANCE = 4
SEED = 42
_ROWS = 1 << 20
_PAIRS = 1 << 22

# Fixed value: generator polynomial of the perfect binary Golay code (23, 12).
GOLAY = 0b110001110101


def _shingle_hashes(text: bytes, size: int) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(length) - 1
    start = (end - length + 1).tolist()
    last = end[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(start, last)]


def fingerprints_of(texts: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """A bit is set if over half of the shingles' hashes have it, repeats counted."""
    out = np.zeros(len(texts), U)
    group: list[int] = []
    hashes: list[int] = []

    def settle() -> None:
        if not hashes:
            return
        owner = np.array(group)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        count = np.diff(np.append(first, len(owner)))
        out[owner[first]] = np.packbits(ones * 2 > count[:, None], axis=1).view(">u8").ravel()
        group.clear()
        hashes.clear()

    for i, text in enumerate(texts):
        got = _shingle_hashes(text, size)
        hashes += got
        group += [i] * len(got)
        if len(hashes) > 1 << 18:
            settle()
    settle()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, fp) of every document; fp holds the unsigned bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprints_of([bytes(v) for v in column_bytes(batch.column(1))], size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")
    )
    return rows.mapInArrow(run, "id long, fp long")


# --- covering code of a half: Golay (23, 12) x repetition (3, 1) three times ---


def _golay_column(bit: int) -> int:
    value = 1 << bit
    for k in range(22, 10, -1):
        if value >> k & 1:
            value ^= GOLAY << (k - 11)
    return value


@lru_cache(maxsize=1)
def _factors() -> list[tuple[int, int, list[int]]]:
    """(first bit, covering radius, parity column of each bit) of each factor."""
    return [(0, 3, [_golay_column(i) for i in range(23)])] + [(23 + 3 * k, 1, [1, 2, 3]) for k in range(3)]


def _light_vectors(columns: list[int], radius: int, excess: int):
    """Vectors up to radius + excess: bits, syndrome, weight above the radius."""
    bits, syndrome, weight = np.zeros(1, U), np.zeros(1, np.int64), np.zeros(1, np.int64)
    top = np.full(1, -1)
    out = [(bits, syndrome, weight)]
    for w in range(1, min(radius + excess, len(columns)) + 1):
        count = len(columns) - 1 - top
        i = np.repeat(np.arange(len(bits)), count)
        new = ranges(top + 1, count)
        bits = bits[i] | (U(1) << new.astype(U))
        syndrome = syndrome[i] ^ np.array(columns)[new]
        top = new
        out.append((bits, syndrome, np.full(len(bits), max(0, w - radius))))
    return [np.concatenate(x) for x in zip(*out)]


@lru_cache(maxsize=2)
def _offsets(threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Differences to all anchors in reach, by syndrome of a half: (starts,
    differences).  The first of a syndrome leads to the home anchor."""
    bits, syndrome, excess, shift = np.zeros(1, U), np.zeros(1, np.int64), np.zeros(1, np.int64), 0
    for first, radius, columns in _factors():
        b, s, e = _light_vectors(columns, radius, threshold)
        total = excess[:, None] + e[None, :]
        i, j = np.nonzero(total <= threshold)
        bits = bits[i] | (b[j] << U(first))
        syndrome, excess = syndrome[i] | (s[j] << shift), total[i, j]
        shift += max(columns).bit_length()
    order = np.lexsort((bits, excess, syndrome))
    starts = np.searchsorted(syndrome[order], np.arange((1 << shift) + 1))
    return starts, bits[order]


def _syndromes(half: np.ndarray) -> np.ndarray:
    out, shift = np.zeros(len(half), np.int64), 0
    for first, _, columns in _factors():
        for i, column in enumerate(columns):
            out ^= ((half >> U(first + i)) & U(1)).astype(np.int64) * (column << shift)
        shift += max(columns).bit_length()
    return out


def anchors(fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, is home) for every anchor that each fingerprint goes to;
    bit 32 of an anchor tells the halves apart."""
    starts, differences = _offsets(threshold)
    rows, keys, homes = [], [], []
    for side in (0, 1):
        half = (fp >> U(32 * side)) & U(0xFFFFFFFF)
        s = _syndromes(half)
        count = starts[s + 1] - starts[s]
        row = np.repeat(np.arange(len(fp)), count)
        keys.append((half[row] ^ differences[ranges(starts[s], count)]) | U(side << 32))
        home = np.zeros(len(row), bool)
        home[np.cumsum(count) - count] = True
        rows.append(row)
        homes.append(home)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def _replicate(hot: dict[int, int], buckets: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fp = batch.column(0).to_numpy().view(U)
            for lo in range(0, len(all_fp), _ROWS // 128):
                fp = all_fp[lo : lo + _ROWS // 128]
                row, key, home = anchors(fp, threshold)
                # a home is a replica too: it is compared with the other homes
                row, key = np.concatenate([row, row[home]]), np.concatenate([key, key[home]])
                home = np.concatenate([np.zeros(len(home), bool), np.ones(int(home.sum()), bool)])
                copy, cell = grid.spread(key, home, fp[row], hot)
                key, home, row = key[copy], home[copy], row[copy]
                bucket = (mix(key * U(0x9E3779B97F4A7C15) + cell.astype(U)) % U(buckets)).astype(np.int32)
                # the grid's cells are told apart within their bucket
                parts = list(split(bucket, key | (cell.astype(U) << U(33)), fp[row], home))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary())],
                    names=["bucket", "payload"],
                )

    return run


def _compare(distance: int):
    def run(table: pa.Table) -> pa.Table:
        parts = [unpack(p, "u8", "u8", "?") for p in column_bytes(table.column("payload"))]
        key, fp, home = (np.concatenate(x) for x in zip(*parts))
        names, node = np.unique(fp, return_inverse=True)
        order = np.lexsort((~home, key))
        key, fp, home, node = key[order], fp[order], home[order], node[order]
        first = np.flatnonzero(np.diff(key, prepend=key[:1] ^ U(1)))
        count = np.diff(np.append(first, len(key)))
        homes = np.add.reduceat(home.astype(np.int64), first)
        root = np.arange(len(names))
        for x, y in grid.pair_chunks(first, homes, first + homes, count - homes, _PAIRS):
            near = np.bitwise_count(fp[x] ^ fp[y]) <= distance
            nx, ny = root[node[x[near]]], root[node[y[near]]]
            apart = nx != ny
            if apart.any():
                root = local_stars(len(names), np.concatenate([np.arange(len(names)), nx[apart]]), np.concatenate([root, ny[apart]]))
        linked = np.flatnonzero(root != np.arange(len(names)))
        return pa.table(
            [pa.array(names[linked].view(np.int64)), pa.array(names[root[linked]].view(np.int64))], names=["a", "b"]
        )

    return run


def links(nodes: DataFrame, distance: int = DISTANCE, cell: int = grid.CELL) -> DataFrame:
    """Star edges (a, b) that connect the distinct fingerprints ``fp`` of
    ``nodes`` exactly as all links within ``distance`` bits do."""
    spark = nodes.sparkSession
    threshold = distance // 2

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, key, home = anchors(batch.column(0).to_numpy().view(U), 0)
            yield pa.RecordBatch.from_arrays([pa.array(key[home].view(np.int64))], names=["key"])

    n = nodes.count()
    hot = grid.crowded(nodes.select("fp").mapInArrow(homes, "key long"), 2 * n, cell)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n * 80 // _ROWS)
    return (
        nodes.select("fp").mapInArrow(_replicate(hot, buckets, threshold), "bucket int, payload binary")
        .groupBy("bucket").applyInArrow(_compare(distance), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """(id, fp, component): component is the smallest id reachable by links."""
    found = scratch.written(fingerprints(docs, id_col, text_col, size), "fingerprints")
    nodes = scratch.written(found.groupBy("fp").agg(F.min("id").alias("smallest")), "distinct-fingerprints")
    roots = components(links(nodes, distance))
    grouped = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root")
    )
    least = grouped.groupBy("root").agg(F.min("smallest").alias("component"))
    of_fp = grouped.join(least, "root").select("fp", "component")
    return found.join(of_fp, "fp").select("id", "fp", "component")

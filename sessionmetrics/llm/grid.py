"""Comparing homes with replicas, key by key, when some keys are crowded.

A row is home at one key and replicated to others; the members of a key that
are home there are compared with all rows that came to it.  A crowded key is
cut into a square grid of cells: a home goes to every cell of its line, a
replica to every cell of its column, so each home meets each replica in
exactly one cell and no task holds a whole crowded key.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import U, mix, ranges

#: Homes of one key compared in one cell, and the most crowded keys sent to tasks.
CELL, HOT_KEYS = 4096, 20_000


def crowded(homes: DataFrame, n_homes: int, cell: int = CELL) -> dict[int, int]:
    """Grid width of each key of ``homes`` (key: long) with more than ``cell``
    rows.  The cell grows with the table, so that at most ``HOT_KEYS`` keys
    can be above it: what is sent to the tasks stays bounded."""
    cell = max(cell, n_homes // HOT_KEYS)
    counts = homes.groupBy("key").count().where(F.col("count") > cell)
    return {r[0] & 0xFFFFFFFFFFFFFFFF: -(-r[1] // cell) for r in counts.collect()}


def spread(key: np.ndarray, home: np.ndarray, own: np.ndarray, hot: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) copies of the rows; ``own`` is a hash of each row's item."""
    if not hot:
        return np.arange(len(key)), np.zeros(len(key), np.int64)
    names = np.array(sorted(hot), U)
    widths = np.array([hot[int(k)] for k in names], np.int64)
    at = np.minimum(np.searchsorted(names, key), len(names) - 1)
    width = np.where(names[at] == key, widths[at], 1)
    row = np.repeat(np.arange(len(key)), width)
    other, width = ranges(np.zeros(len(key), np.int64), width), width[row]
    mine = (mix(own[row]) % width.astype(U)).astype(np.int64)
    return row, np.where(home[row], mine * width + other, other * width + mine)


def pair_chunks(first: np.ndarray, homes: np.ndarray, start: np.ndarray, count: np.ndarray, most: int):
    """(x, y) row pairs of each group's ``homes`` rows from ``first`` on with
    its ``count`` rows from ``start`` on, about ``most`` pairs at a time."""
    live = (homes > 0) & (count > 0)
    first, homes, start, count = first[live], homes[live], start[live], count[live]
    x_all = ranges(first, homes)
    start, n = np.repeat(start, homes), np.repeat(count, homes)
    total = np.cumsum(n)
    cuts = np.searchsorted(total, np.arange(0, int(n.sum()) + most, most))
    for a, b in zip(cuts, [*cuts[1:], len(x_all)]):
        if a < b:
            yield np.repeat(x_all[a:b], n[a:b]), ranges(start[a:b], n[a:b])

"""Packing documents into fixed-length sequences: a grouping genetic algorithm.

``pieces`` tokenises whole texts and cuts only documents longer than a
sequence; ``pack`` places the pieces in as few sequences as it can.

Full pieces are sequences of their own.  The others are dealt into groups of
bounded size.  Each group is evolved on several islands: a solution is a set
of bins; crossover injects whole well-filled bins of one parent into the
other, removes the bins that now hold a document twice, and best-fits the
displaced documents.  After every epoch each island hands its elite to the
next one, through a shuffle.  The best island of a group wins; what its
poorly filled bins hold is dealt into new groups once more, so a group's last
bin is not lost space.

Nulls and edges: a null or empty text is one piece with the end id alone; a
null id is kept as it is; repeated rows are packed as often as they occur;
no rows give no sequences.  A text of any length is tokenised whole.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scratch, token_ids
from .blocks import column_bytes

SEQUENCE = 2048
END_ID = 0
GROUP_PIECES = 1024
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 8
POPULATION = 4
WELL_FILLED = 0.97


class Encoder:
    """Ids of many texts at once (see ``token_ids``)."""

    def __init__(self, vocabulary: str):
        self.texts = token_ids.encoder(vocabulary)

    def encode(self, texts: list[bytes | memoryview]) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) for every text."""
        for row, ids in enumerate(self.texts.encode(texts)):
            yield row, np.frombuffer(ids, "<u4")


def pieces(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE) -> DataFrame:
    """Tokenised documents cut to at most ``sequence`` ids: (id, piece, start,
    length, ids), each document followed by the end id.  Of a longer one the
    first piece may be shorter.  The vocabulary file is read by the driver
    and sent to the tasks; it does not grow with the corpus."""
    with open(vocabulary_path, encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        for batch in batches:
            ids = batch.column(0)
            rows: list[tuple[int, int, int, int, bytes]] = []
            for row, got in encoder.encode(column_bytes(batch.column(1))):
                got = np.append(got, np.uint32(END_ID)).astype("<u4")
                n = len(got)
                cuts = [0, n] if n <= sequence else sorted({0, *range(n, 0, -sequence)})
                rows += [(row, k, a, b - a, got[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                if len(rows) >= 1024:
                    yield _rows(ids, rows)
                    rows = []
            yield _rows(ids, rows)

    def _rows(ids: pa.Array, rows: list) -> pa.RecordBatch:
        row, piece, start, length, data = zip(*rows) if rows else ((),) * 5
        return pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(data, pa.binary()),
            ],
            names=["id", "piece", "start", "length", "ids"],
        )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, piece int, start long, length long, ids binary")


class Solution:
    """Bins over the pieces of a group: the bin of each piece."""

    def __init__(self, bin_of: np.ndarray, sizes: np.ndarray, capacity: int):
        _, self.bin_of = np.unique(bin_of, return_inverse=True)
        self.fill = np.bincount(self.bin_of, sizes).astype(np.int64)
        # fewer bins first; among equals, the more unevenly filled
        self.rank = (len(self.fill), -float(np.square(self.fill / capacity).sum()))


def best_fit(bin_of: np.ndarray, free: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Put the free pieces, largest first, where the least room is left over."""
    bin_of = bin_of.copy()
    used = np.unique(bin_of[bin_of >= 0])
    fill = np.bincount(bin_of[bin_of >= 0], sizes[bin_of >= 0], minlength=len(bin_of) + 1).astype(np.int64)
    room = sorted((capacity - int(fill[b]), int(b)) for b in used)
    fresh = int(used.max()) + 1 if len(used) else 0
    for i in free[np.argsort(-sizes[free], kind="stable")].tolist():
        size = int(sizes[i])
        at = bisect.bisect_left(room, (size, -1))
        left, where = room.pop(at) if at < len(room) else (capacity, fresh)
        fresh += where == fresh
        bin_of[i] = where
        bisect.insort(room, (left - size, where))
    return bin_of


def crossover(a: Solution, b: Solution, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> Solution:
    """Inject well-filled bins of ``b`` into ``a``."""
    good = np.flatnonzero(b.fill >= WELL_FILLED * capacity)
    if not len(good):
        good = np.argsort(-b.fill, kind="stable")[: max(1, len(b.fill) // 4)]
    good = good[rng.random(len(good)) < 0.5]
    injected = np.isin(b.bin_of, good)
    hit = np.zeros(len(a.fill), bool)
    hit[a.bin_of[injected]] = True
    # bins that are poorly filled anyway are dissolved with those that hold a piece twice
    hit |= (a.fill < WELL_FILLED * capacity) & (rng.random(len(a.fill)) < 0.5)
    child = np.where(hit[a.bin_of], -1, a.bin_of)
    child[injected] = len(a.fill) + b.bin_of[injected]
    _, child[child >= 0] = np.unique(child[child >= 0], return_inverse=True)
    return Solution(best_fit(child, np.flatnonzero(child < 0), sizes, capacity), sizes, capacity)


def evolve(sizes: np.ndarray, capacity: int, seeds: list[np.ndarray], rng: np.random.Generator, generations: int = GENERATIONS, population: int = POPULATION) -> Solution:
    """The elite after some generations on one island."""
    everything, empty = np.arange(len(sizes)), np.full(len(sizes), -1)
    people = [Solution(s, sizes, capacity) for s in seeds]
    people.append(Solution(best_fit(empty, everything, sizes, capacity), sizes, capacity))
    least = -(-int(sizes.sum()) // capacity)
    while len(people) < population:
        # other starts: some pieces first, in any order
        some = np.flatnonzero(rng.random(len(sizes)) < 0.3)
        start = best_fit(empty, some, sizes, capacity)
        people.append(Solution(best_fit(start, np.flatnonzero(start < 0), sizes, capacity), sizes, capacity))
    for _ in range(generations):
        people.sort(key=lambda p: p.rank)
        if people[0].rank[0] == least:
            break
        children = [
            crossover(people[i], people[j], sizes, capacity, rng)
            for i, j in rng.permuted(np.tile(np.arange(population), (population // 2 + 1, 1)), axis=1)[:, :2]
        ]
        people = sorted(people + children, key=lambda p: p.rank)[:population]
    return min(people, key=lambda p: p.rank)


_EVOLVED = "grp long, island int, item long, length long, bin int, n_bins int, fitness double"


def _epoch(rows: DataFrame, capacity: int, epoch: int, seed: int) -> DataFrame:
    """rows: (grp, island, origin, item, length, bin); bin is null at first."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["origin", "length", "item"], ascending=[True, False, True], kind="stable")
        solutions = [g for _, g in group.groupby("origin", sort=True)]
        items = solutions[0]
        sizes = items["length"].to_numpy(np.int64)
        seeds = [g["bin"].to_numpy(np.int64) for g in solutions if epoch]
        rng = np.random.default_rng([seed, epoch, *(int(k) for k in key)])
        best = evolve(sizes, capacity, seeds, rng)
        return pd.DataFrame({
            "grp": key[0], "island": key[1], "item": items["item"].to_numpy(), "length": sizes,
            "bin": best.bin_of, "n_bins": best.rank[0], "fitness": best.rank[1],
        })

    return rows.groupBy("grp", "island").applyInPandas(run, _EVOLVED)


def _evolved(items: DataFrame, capacity: int, seed: int, islands: int, epochs: int) -> DataFrame:
    """items: (grp, item, length) -> (grp, item, length, bin, fill)."""
    rows = items.select(
        "grp", F.explode(F.array(*map(F.lit, range(islands)))).alias("island"),
        F.lit(0).alias("origin"), "item", "length", F.lit(0).alias("bin"),
    )
    for epoch in range(epochs):
        found = scratch.written(_epoch(rows, capacity, epoch, seed), "islands")
        # every island keeps its elite and hands a copy to the next
        handed = F.explode(F.array(F.col("island"), (F.col("island") + 1) % islands)).alias("to")
        rows = found.select("grp", handed, "island", "item", "length", "bin").select(
            "grp", F.col("to").alias("island"), F.col("island").alias("origin"), "item", "length", "bin"
        ).distinct()
    best = found.groupBy("grp").agg(F.min(F.struct("n_bins", "fitness", "island")).alias("best"))
    found = found.join(best, "grp").where(F.col("island") == F.col("best.island"))
    fill = found.groupBy("grp", "bin").agg(F.sum("length").alias("fill"))
    return found.join(fill, ["grp", "bin"]).select("grp", "item", "length", "bin", "fill")


def pack(
    rows: DataFrame, sequence: int = SEQUENCE, seed: int = 42, islands: int = ISLANDS, epochs: int = EPOCHS,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """``rows`` (with a column ``length``, 1..sequence) with the columns
    ``sequence_id`` and ``offset``."""
    rows = scratch.written(rows.withColumn("_item", F.monotonically_increasing_id()), "pieces")
    full = rows.where(F.col("length") == sequence).select(
        "_item", F.col("_item").alias("_seq"), F.lit(0).cast("long").alias("offset")
    )
    partial = rows.where(F.col("length") < sequence).select(F.col("_item").alias("item"), "length")

    def dealt(items: DataFrame, salt: int) -> DataFrame:
        groups = max(1, -(-items.count() // group_pieces))
        return items.withColumn("grp", F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(groups)))

    first = scratch.written(_evolved(dealt(partial, seed), sequence, seed, islands, epochs), "packed")
    poor = F.col("fill") < WELL_FILLED * sequence
    again = _evolved(dealt(first.where(poor).select("item", "length"), seed + 1), sequence, seed + 1, islands, epochs)
    # three kinds of sequence, told apart by the two low bits of their number
    number = F.col("grp") * F.lit(1 << 24) + F.col("bin") * 4
    placed = first.where(~poor).withColumn("_seq", number + 1).unionByName(again.withColumn("_seq", number + 2))
    order = Window.partitionBy("_seq").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select(
        F.col("item").alias("_item"), "_seq", F.coalesce(F.sum("length").over(order), F.lit(0)).cast("long").alias("offset")
    )
    places = full.withColumn("_seq", F.col("_seq") * 4).unionByName(placed)
    return rows.join(places, "_item").withColumnRenamed("_seq", "sequence_id").drop("_item")

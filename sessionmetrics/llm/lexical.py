"""Ranked lexical search: items against all documents, equal bags scored once.

Documents are reduced to what the items can see of them: their term
frequencies over the items' vocabulary, and m, a whole number that stands for
their length.  Documents with the same bag (frequencies and m) get the same
score for every item, so they form one class: Spark deals bags by their hash
and sorts by hash, m and the bag itself, which verifies that the members of a
class are identical.  Every class is scored once against all items, in blocks
of classes; the best classes of an item are then expanded into their members
by ascending doc_id.

No more than the first k members of a class can be among an item's k best
rows, and no more than the k best classes (by score, then by their first
member) can hold them, so both are cut there; that loses nothing.  A class of
any size reaches its task as k rows from each part of the table.

The items' terms are broadcast.  Items are dealt into waves whose terms take
``WAVE_BYTES`` at most on average, one search over all documents for each
wave, so that the broadcast does not grow with the items.

Nulls and edges: a null or empty text has no terms and is in no result; an
item without terms, or whose terms no document has, has no rows; every row of
the item table is an item, and every row of the document table a document,
also when ids are repeated; a null doc_id comes last among equal scores; no
documents give no rows.  Texts of any length are taken whole.  Other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import scratch
from .blocks import column_bytes, pack, unpack

#: Maximal runs outside [\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F], as UTF-8 bytes.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
BEST = 10
#: Fixed values of the scoring rule.
SCALE, FREQUENCY, LENGTH = 1_000_000_000, 1000, 8
BASE, SLOPE = 100, 90
WAVE_BYTES = 4 << 20
#: Classes scored together.
_TOGETHER = 2048
#: A term that one item in so many has is added up as a matrix column.
_DENSE = 16
_NO_ID = np.iinfo(np.int64).max


def terms_of(text) -> list[bytes]:
    """The terms of a text's UTF-8 bytes, A-Z lower-cased."""
    return TERM.findall(bytes(text).lower())


def _item_terms(items: DataFrame) -> DataFrame:
    """(item, term): the distinct terms of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1))):
                found = sorted(set(terms_of(text)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.int64()), pa.array(found, pa.binary())], names=["item", "term"]
                )

    return items.mapInArrow(run, "item long, term binary")


class Wave:
    """The terms of some items: a number for each term, the items that have it."""

    def __init__(self, item: np.ndarray, term: list[bytes]):
        self.items = np.unique(item)
        self.terms = sorted(set(term))
        self.number = {t: i for i, t in enumerate(self.terms)}
        which = np.fromiter((self.number[t] for t in term), np.int64, len(term))
        order = np.argsort(which, kind="stable")
        #: items (by place) that have term t: holders[first[t]:first[t + 1]]
        self.holders = np.searchsorted(self.items, item[order])
        self.first = np.searchsorted(which[order], np.arange(len(self.terms) + 1))


def _bags(docs: DataFrame, wave) -> DataFrame:
    """(doc_id, n, bag): the number of all terms, and the numbers of the
    wave's terms with their frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = wave.value.number
        for batch in batches:
            n, bags = [], []
            for text in column_bytes(batch.column(1)):
                found = Counter(terms_of(text))
                n.append(sum(found.values()))
                known = sorted((number[t], tf) for t, tf in found.items() if t in number)
                columns = np.array(known, np.int64).reshape(-1, 2)
                bags.append(pack(columns[:, 0].astype("<u4"), columns[:, 1].astype("<u8")) if known else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(bags, pa.binary())], names=["doc_id", "n", "bag"]
            )

    return docs.mapInArrow(run, StructType([docs.schema["doc_id"], *_fields("n long, bag binary")]))


def _fields(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def _document_frequency(bags: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            numbers = [unpack(v, "<u4")[0] for v in column_bytes(batch.column(0)) if len(v)]
            if numbers:
                seen.update(dict(zip(*(x.tolist() for x in np.unique(np.concatenate(numbers), return_counts=True)))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["term", "df"]
        )

    return bags.select("bag").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class _Best:
    """The k best (score, first member) of every item so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(3)]  # item, score, first member
        self.classes: list[tuple] = []

    def add(self, scores: np.ndarray, first: np.ndarray, classes: list[tuple]) -> None:
        """``scores`` by item and class."""
        item, which = np.nonzero(scores >= self.least[:, None])
        old = len(self.classes)
        rows = [np.concatenate(x) for x in zip(self.rows, (item, scores[item, which], first[which]))]
        place = np.concatenate([np.arange(old), old + which])
        order = np.lexsort((rows[2], -rows[1], rows[0]))
        begin = np.searchsorted(rows[0][order], rows[0][order])
        order = order[np.arange(len(order)) - begin < self.k]
        self.rows = [x[order] for x in rows]
        all_classes = self.classes + classes
        self.classes = [all_classes[i] for i in place[order]]
        last = np.flatnonzero(np.diff(self.rows[0], append=-1))
        full = last[np.bincount(self.rows[0], minlength=len(self.least))[self.rows[0][last]] >= self.k]
        self.least[self.rows[0][full]] = self.rows[1][full]


def score_block(wave: Wave, weight: np.ndarray, m: np.ndarray, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Scores by item and class, exact in 64 bits."""
    n_items, n_classes = len(wave.items), len(bags)
    cls = np.repeat(np.arange(n_classes), [len(t) for t, _ in bags])
    term = np.concatenate([t for t, _ in bags]).astype(np.int64)
    tf = np.concatenate([f for _, f in bags]).astype(np.int64)
    gain = weight[term] * ((SCALE * tf) // (FREQUENCY * tf + LENGTH * m[cls]))
    held = wave.first[term + 1] - wave.first[term]
    # sums in doubles are exact below 2**53, so the low and the high bits are added apart
    low, high = (gain & 0xFFFFFF).astype(np.float64), (gain >> 24).astype(np.float64)
    out = np.zeros((n_items, n_classes), np.int64)
    dense = held * _DENSE > n_items
    if dense.any():
        number, column = np.unique(term[dense], return_inverse=True)
        has = np.zeros((n_items, len(number)))
        for j, t in enumerate(number.tolist()):
            has[wave.holders[wave.first[t] : wave.first[t + 1]], j] = 1.0
        for part, shift in ((low, 0), (high, 24)):
            x = np.zeros((len(number), n_classes))
            x[column, cls[dense]] = part[dense]
            out += (has @ x).astype(np.int64) << shift
    rare = np.flatnonzero(~dense)
    if len(rare):
        count = held[rare]
        begin = np.cumsum(count) - count
        item = wave.holders[np.arange(int(count.sum())) + np.repeat(wave.first[term[rare]] - begin, count)]
        cell = item * n_classes + np.repeat(cls[rare], count)
        for part, shift in ((low, 0), (high, 24)):
            total = np.bincount(cell, np.repeat(part[rare], count), minlength=n_items * n_classes)
            out += total.reshape(n_items, n_classes).astype(np.int64) << shift
    return out


def _best_classes(classes: DataFrame, sent, k: int) -> DataFrame:
    """(item, score, first, h, m, bag): each task's best classes of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave, weight = sent.value
        best = _Best(len(wave.items), k)
        for batch in batches:
            h, m, first = (batch.column(i).to_pylist() for i in (0, 1, 3))
            views = column_bytes(batch.column(2))
            for lo in range(0, len(h), _TOGETHER):
                some = range(lo, min(lo + _TOGETHER, len(h)))
                bags = [tuple(unpack(views[i], "<u4", "<u8")) for i in some]
                scores = score_block(wave, weight, np.array([m[i] for i in some], np.int64), bags)
                ids = np.array([_NO_ID if first[i] is None else first[i] for i in some], np.int64)
                best.add(scores, ids, [(h[i], m[i], bytes(views[i])) for i in some])
        item, score, first_id = best.rows
        h, m, bag = zip(*best.classes) if best.classes else ((),) * 3
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(wave.items[item], pa.int64()), pa.array(score, pa.int64()), pa.array(first_id, pa.int64()),
                pa.array(h, pa.int64()), pa.array(m, pa.int64()), pa.array(bag, pa.binary()),
            ],
            names=["item", "score", "first", "h", "m", "bag"],
        )

    return classes.mapInArrow(run, "item long, score long, first long, h long, m long, bag binary")


def _first(rows: DataFrame, per: list[str], order: list, k: int, rank: str = "rn") -> DataFrame:
    window = Window.partitionBy(*per).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def _search_wave(docs: DataFrame, wave: Wave, k: int) -> DataFrame | None:
    """(item, rank, doc_id, score) for the items of one wave."""
    sc = docs.sparkSession.sparkContext
    bags = scratch.written(_bags(docs, sc.broadcast(wave)), "bags")
    n_docs, n_terms = bags.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_docs:
        return None
    weight = np.zeros(len(wave.terms), np.int64)
    for term, df in _document_frequency(bags).collect():  # at most the wave's terms
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    m = F.expr(f"{BASE - SLOPE}L + (({SLOPE}L * n * {n_docs}L) div {n_terms}L)")
    keyed = bags.where(F.octet_length("bag") > 0).select(m.alias("m"), "bag", "doc_id")
    keyed = keyed.select(F.xxhash64("m", "bag").alias("h"), "m", "bag", "doc_id")
    same = ["h", "m", "bag"]
    members = scratch.written(_first(keyed, same, [F.asc_nulls_last("doc_id")], k), "members")
    classes = members.where(F.col("rn") == 1).select(*same, F.col("doc_id").alias("first"))
    found = _best_classes(classes, sc.broadcast((wave, weight)), k)
    found = _first(found, ["item"], [F.desc("score"), F.asc("first")], k).drop("rn", "first")
    rows = found.join(members.drop("rn"), same)
    rows = _first(rows, ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")], k, "rank")
    return rows.select("item", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", k: int = BEST, wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its ``k`` best documents
    with a score above 0, highest first, equal scores by ascending doc_id.

    Terms are the maximal runs of ASCII letters, digits and other characters
    from U+0080 on, A-Z lower-cased.  N is the number of documents with a
    term, L the number of all their terms, n a document's terms, df the
    documents that hold a term, tf its occurrences.  A term weighs
    floor(1000 ln((2N + 2) / (2df + 1))), m is 10 + (90 n N) div L, and a
    document's score adds up w * ((10**9 tf) div (1000 tf + 8 m)) over the
    item's distinct terms."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast(LongType()).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    rows = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("binary").alias("text"))
    rows = scratch.written(rows.withColumn("item", F.monotonically_increasing_id()), "items")
    terms = scratch.written(_item_terms(rows.select("item", "text")), "item-terms")
    n_bytes = terms.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    waves = -(-n_bytes // wave_bytes)
    out = None
    for w in range(waves):
        part = terms.where(F.pmod(F.xxhash64("item"), F.lit(waves)) == w).toArrow()
        if not part.num_rows:
            continue
        found = _search_wave(texts, Wave(part.column("item").to_numpy(), part.column("term").to_pylist()), k)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "item long, rank int, doc_id long, score long")
    return out.join(rows.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

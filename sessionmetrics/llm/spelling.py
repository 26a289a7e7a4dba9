"""Spelling variants: words within one edit, found along sorted word lists.

The vocabulary is kept as two sorted lists, of the words and of the words
written backwards, range-partitioned by Spark into blocks of some thousand
words.  A query word is looked up in a block by dynamic programming: the edit
matrix between it and the list's words is built row by row, one row per
letter of the list's word, and only the three cells about the diagonal, for
no more than one edit counts.  Neighbouring words share the rows of their
common prefix (their LCP), so a row is computed once for the whole range of
words with that prefix, and a range is skipped as soon as its shared prefix
exceeds one edit.  All queries of a block go down the list together, level by
level, in numpy.

Two words that are one edit apart agree in their first half or in their last
half.  So a query visits, in each list, only the words that begin like it: p
letters, p being half its length less one.  That range lies in its own block
or runs on into the next ones; a query is copied to those it can still reach
(the block's shared prefix is run through the same matrix), so a crowded
prefix is cut into blocks like any other part of the list.

``variants`` follows every word to its most frequent near word, if that is
ten times as frequent, and on to the last of such forms.

Nulls and edges: a null text has no words; a null id counts as the text
``null`` where ids decide about letters; a text or word of any length is
taken whole; repeated rows count as often as they occur; words with equal
counts are ordered by code points; an empty table has no words; other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch

#: Words of at least so many letters, seen at least so often, are compared.
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is so many times as frequent as its variant.
FORM_RATIO = 10
#: One run in so many loses a letter (see ``count_words``).
DAMAGED = 31
#: Words of a block, and queries that go down a list together.
BLOCK_WORDS = 1 << 14
_TOGETHER = 1 << 15
#: Letters of a block's first and last word that are sent to all tasks.
_BOUND = 64
#: Distinct words that a task gathers before it passes them on.
_GATHERED = 1 << 18
#: From this depth on, the few pairs that are left are compared at once.
_DEEP = 64
_DEAD = 2


def _damaged(run: bytes, id_hash: int, modulus: int) -> bytes:
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), id_hash)
    if h % modulus:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, damaged: int = DAMAGED,
) -> DataFrame:
    """(word, n): the words of all texts with their occurrences.

    Words are maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z lower-cased.  Where
    ``damaged`` divides the crc32 h of ``<id>:<run>``, the run loses its letter
    h modulo its length.  Tasks add up their own words before the shuffle."""
    # in Latin-1 a letter is one byte, and what is not Latin-1 becomes "?"
    runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % max(1, least_length))

    def rows(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())],
            names=["word", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                id_hash = zlib.crc32(f"{key}:".encode())
                found = Counter(runs.findall(text.as_py().encode("latin-1", "replace").lower()))
                for word, n in found.items():
                    word = _damaged(word, id_hash, damaged)
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) >= _GATHERED:
                    yield rows(total)
                    total = Counter()
        yield rows(total)

    texts = docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.col(text_col).cast("string").alias("text")
    )
    counted = texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


class WordList:
    """Words as one array of letters (Latin-1 bytes) with their bounds."""

    def __init__(self, words: list[str]):
        data = "".join(words).encode("latin-1")
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.length) - self.length
        self.letters = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(1, np.uint8)]).astype(np.int64)

    def __len__(self) -> int:
        return len(self.length)

    def at(self, word: np.ndarray, place) -> np.ndarray:
        """The letters of words at a place; 0 where there is none."""
        inside = (place >= 0) & (place < self.length[word])
        return np.where(inside, self.letters[np.where(inside, self.start[word] + place, len(self.letters) - 1)], 0)

    def word(self, i: int) -> np.ndarray:
        return self.letters[self.start[i] : self.start[i] + self.length[i]]


def shared_half(length):
    """How many letters a query shares with the words it visits."""
    return (length - 1) // 2


def _next_row(a, b, c, x, before, here, after, left):
    """The three cells about the diagonal after one more letter ``x`` of the
    list.  ``before``, ``here`` and ``after`` are the query's letters about the
    diagonal, ``left`` the letters the query has left on the diagonal."""
    new_a = np.where(left >= 0, np.minimum(a + (before != x), b + 1), _DEAD)
    new_b = np.where(left >= 1, np.minimum(np.minimum(b + (here != x), c + 1), new_a + 1), _DEAD)
    new_c = np.where(left >= 2, np.minimum(c + (after != x), new_b + 1), _DEAD)
    return tuple(np.minimum(v, _DEAD).astype(np.int8) for v in (new_a, new_b, new_c))


def _one_edit(u: np.ndarray, v: np.ndarray) -> bool:
    if len(u) > len(v):
        u, v = v, u
    if len(v) - len(u) > 1:
        return False
    apart = np.flatnonzero(u != v[: len(u)])
    if not len(apart):
        return len(v) > len(u)
    i = int(apart[0])
    return np.array_equal(u[i + 1 :], v[i + 1 :]) if len(u) == len(v) else np.array_equal(u[i:], v[i + 1 :])


def near_in_list(words: WordList, queries: WordList) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) for all words one edit from a query among the sorted
    ``words`` that begin with the query's first half."""
    found = [
        _descend(words, queries, np.arange(lo, min(lo + _TOGETHER, len(queries))))
        for lo in range(0, len(queries), _TOGETHER)
    ]
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *(f[i] for f in found)]) for i in (0, 1))


def _descend(words: WordList, queries: WordList, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = shared_half(queries.length)
    found_q: list[np.ndarray] = []
    found_w: list[np.ndarray] = []
    # words still on the way, each with the number of its prefix of this depth
    on, prefix = np.arange(len(words)), np.zeros(len(words), np.int64)
    # states: a query, the prefix it stands at, and its row's three cells
    at = np.zeros(len(q), np.int64)
    a, b, c = (np.full(len(q), v, np.int8) for v in (_DEAD, 0, 1))
    depth = 0
    while len(q) and len(on):
        begins = half[q] > depth
        # a word that ends here is found if the query ends in a cell of one edit
        done = words.length[on] == depth
        if done.any():
            ends = np.full(int(prefix[-1]) + 1, -1, np.int64)
            ends[prefix[done]] = on[done]
            over = queries.length[q] - depth
            cell = np.where(over == 0, b, np.where(over == -1, a, np.where(over == 1, c, _DEAD)))
            word = np.where(at < len(ends), ends[np.minimum(at, len(ends) - 1)], -1)
            hit = np.flatnonzero((cell == 1) & (word >= 0) & ~begins)
            found_q.append(q[hit])
            found_w.append(word[hit])
            on, prefix = on[~done], prefix[~done]
        if depth >= _DEEP:
            lo, hi = np.searchsorted(prefix, at), np.searchsorted(prefix, at, side="right")
            if (hi - lo).sum() <= 4 * len(q) + 1024:
                pairs = {(i, int(w)) for i, x, y in zip(q.tolist(), lo.tolist(), hi.tolist()) for w in on[x:y]}
                pairs = [(i, w) for i, w in pairs if _begins_alike(words, queries, i, w, int(half[i]))]
                near = [(i, w) for i, w in pairs if _one_edit(queries.word(i), words.word(w))]
                found_q.append(np.array([i for i, _ in near], np.int64))
                found_w.append(np.array([w for _, w in near], np.int64))
                break
        # the prefixes one letter longer, numbered in order
        key = prefix * 256 + words.at(on, depth)
        fresh = np.diff(key, prepend=-1) != 0
        longer = key[fresh]
        # where the row has no zero (or must not yet use an edit), only words that go on
        # with one of the query's letters about the diagonal can stay within one edit
        before, here, after = (queries.at(q, depth + i) for i in (-1, 0, 1))
        free = (b == 0) & ~begins
        first, last = np.searchsorted(longer, at * 256), np.searchsorted(longer, at * 256 + 256)
        state = [np.repeat(np.flatnonzero(free), (last - first)[free])]
        to = [_ranges(first[free], (last - first)[free])]
        on_b, on_a, on_c = (b <= 1) & ~free, (a == 1) & ~free & ~begins, (c == 1) & ~free & ~begins
        on_a &= ~on_b | (before != here)  # a letter that stands there twice is tried once
        on_c &= (~on_b | (after != here)) & (~on_a | (after != before))
        tries = [(here, on_b), (before, on_a), (after, on_c)]
        for letter, may in tries:
            may = np.flatnonzero(may & (letter > 0))
            want = at[may] * 256 + letter[may]
            where = np.searchsorted(longer, want)
            there = where < len(longer)
            there[there] = longer[where[there]] == want[there]
            state.append(may[there])
            to.append(where[there])
        state, to = np.concatenate(state), np.concatenate(to)
        left = queries.length[q[state]] - depth
        a, b, c = _next_row(
            a[state], b[state], c[state], longer[to] & 255, before[state], here[state], after[state], left
        )
        alive = np.minimum(np.minimum(a, b), c) <= 1
        q, at, a, b, c = q[state][alive], to[alive], a[alive], b[alive], c[alive]
        # words whose prefix nobody stands at are skipped
        number = np.cumsum(fresh) - 1
        wanted = np.zeros(len(longer), bool)
        wanted[at] = True
        on, prefix = on[wanted[number]], number[wanted[number]]
        depth += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_q]), np.concatenate([none, *found_w])


def _begins_alike(words: WordList, queries: WordList, q: int, w: int, n: int) -> bool:
    return np.array_equal(queries.word(q)[:n], words.word(w)[:n])


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - first, counts)


class Routes:
    """Which blocks a query has to visit besides its own."""

    def __init__(self, bounds: list[tuple[int, str, str]]):
        bounds = sorted(bounds, key=lambda b: b[1])
        self.block = [b[0] for b in bounds]
        self.low = [b[1] for b in bounds]
        self.high = [b[2] for b in bounds]

    def others(self, key: str, home: int) -> list[int]:
        n = shared_half(len(key))
        begin = key[: min(n, _BOUND)]
        lo = bisect_left(self.high, begin)
        hi = bisect_left(self.low, _after(begin)) if begin else len(self.low)
        return [
            self.block[i] for i in range(lo, hi) if self.block[i] != home and self._reaches(key, n, i)
        ]

    def _reaches(self, key: str, n: int, i: int) -> bool:
        """Whether the prefix that all words of block i share is within one
        edit of a beginning of ``key``."""
        low, high = self.low[i], self.high[i]
        a, b, c = (np.int8(v) for v in (1, 0, 1))
        for depth, (x, y) in enumerate(zip(low, high)):
            if x != y:
                break
            if depth < n:
                continue  # the first half agrees: its row has a zero on the diagonal
            letters = [ord(key[j]) if 0 <= j < len(key) else 0 for j in (depth - 1, depth, depth + 1)]
            a, b, c = _next_row(a, b, c, ord(x), *letters, len(key) - depth)
            if min(a, b, c) > 1:
                return False
        return True


def _after(prefix: str) -> str:
    """The least text above all texts that begin with ``prefix``."""
    return prefix[:-1] + chr(ord(prefix[-1]) + 1)


def _near_in_direction(words: DataFrame, n_words: int, backward: bool, block_words: int) -> DataFrame:
    """(word, near, near_n) found in one of the two lists."""
    key = F.reverse("word") if backward else F.col("word")
    name = "words-backward" if backward else "words-forward"
    listed = (
        words.select(key.alias("key"), "n").repartitionByRange(max(1, -(-n_words // block_words)), "key")
        .select("key", "n", F.spark_partition_id().alias("block"))
    )
    listed = scratch.written(listed, name)
    # two short texts for every some thousand words
    bounds = listed.groupBy("block").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    bounds = bounds.select("block", F.substring("low", 1, _BOUND), F.substring("high", 1, _BOUND))
    routes = words.sparkSession.sparkContext.broadcast(Routes([tuple(r) for r in bounds.collect()]))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n, block = (batch.column(i).to_pylist() for i in range(3))
            copies = [(i, b) for i, k in enumerate(keys) for b in routes.value.others(k, block[i])]
            rows = np.concatenate([np.arange(len(keys)), np.array([i for i, _ in copies], np.int64)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block + [b for _, b in copies], pa.int32()), batch.column(0).take(pa.array(rows)),
                    batch.column(1).take(pa.array(rows)), pa.array(np.arange(len(rows)) < len(keys)),
                ],
                names=["block", "key", "n", "listed"],
            )

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        keys, at_home = table.column("key").to_pylist(), table.column("listed").to_numpy()
        home = np.flatnonzero(at_home)
        queries, listed_words = WordList(keys), WordList([keys[i] for i in home])
        q, w = near_in_list(listed_words, queries)
        w = home[w]
        if backward:  # what the other list finds too is left to it
            apart = ~_same_ends(queries, q, w)
            q, w = q[apart], w[apart]
            keys = [k[::-1] for k in keys]
        text = pa.array(keys, pa.string())
        return pa.table(
            [text.take(pa.array(q)), text.take(pa.array(w)), table.column("n").take(pa.array(w))],
            names=["word", "near", "near_n"],
        )

    sent = listed.mapInArrow(send, "block int, key string, n long, listed boolean")
    return sent.groupBy("block").applyInArrow(compare, "word string, near string, near_n long")


def _same_ends(words: WordList, q: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Whether words q and w agree in their last letters, half of q's many."""
    same = np.ones(len(q), bool)
    on = np.arange(len(q))
    place = 1
    while len(on):
        on = on[shared_half(words.length[q[on]]) >= place]
        equal = words.at(q[on], words.length[q[on]] - place) == words.at(w[on], words.length[w[on]] - place)
        same[on[~equal]] = False
        on = on[equal]
        place += 1
    return same


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, near, near_n): every ordered pair of ``words`` (word, n; Latin-1
    letters) that differ by exactly one inserted, deleted or replaced letter."""
    n_words = words.count()
    forward = _near_in_direction(words, n_words, False, block_words)
    return forward.unionByName(_near_in_direction(words, n_words, True, block_words))


def _followed(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): every form is followed to the last.

    Counts grow at least ten times with every step, so there are at most 18 in
    64 bits; every round doubles the steps."""
    found = scratch.written(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        rows = found.join(further, "root", "left")
        rows = rows.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        rows = scratch.written(rows, "forms")
        found = rows.select("word", "root")
        if rows.where("moved").isEmpty():
            return found


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, damaged: int = DAMAGED, form_ratio: int = FORM_RATIO,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word (see ``count_words``)."""
    words = scratch.written(count_words(docs, id_col, text_col, least_length, least_count, damaged), "words")
    best = near_words(words, block_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    is_form = -F.col("best.less") >= F.lit(form_ratio) * F.col("n")
    rows = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    rows = scratch.written(rows, "variants")
    roots = _followed(rows.where(F.col("form").isNotNull()))
    rows = rows.join(roots, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

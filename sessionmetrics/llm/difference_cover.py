"""Substring deduplication on words with difference-cover anchors.

A word is removed when a window of ``window`` consecutive words that covers it
also starts in a document with a smaller id.  Hashing every window and
shuffling it would move one row per word.  Instead only positions whose index
in the document is, modulo a period ``v``, in a difference cover are anchors:
for any two positions i and j some shift below v takes both to cover
positions, so two equal windows share an aligned anchor, that is, equal
stretches of ``window - v + 1`` words at the same place in both windows.

1. Every block sends its distinct (anchor stretch, whole surrounding) pairs,
   the surrounding being all words of all windows that hold the anchor.
2. Buckets reply with the first document of each surrounding, and whether the
   stretch has several surroundings.  An occurrence whose surrounding starts
   earlier is covered by earlier windows altogether.
3. Where one stretch has several surroundings, the match is extended: the
   windows around the anchor are compared themselves, once each.

Nothing is capped: a stretch that a third of all documents hold is one row
per block and surrounding.  Equality is decided on 128 bits.

Nulls and edges: a null text has no words; a row whose id is null is left
out; documents shorter than a window keep everything; repeated rows with one
id do not remove each other, since neither id is smaller.  Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from . import scratch
from .text import Rolling, Words

# A perfect difference set for the period 21.
PERIOD = 21
COVER = (0, 1, 4, 14, 16)
WINDOW = 50

RESULT = "id long, n_words long, n_removed long, kept binary"


class _Anchors:
    """Anchors of one block with their stretch and surrounding hashes."""

    def __init__(self, block: B.Block, window: int, period: int, cover: tuple[int, ...]):
        self.words = words = Words(block.data, block.offsets)
        self.owner = words.owner()
        first, last = words.doc[:-1][self.owner], words.doc[1:][self.owner]
        place = np.arange(len(words))
        is_cover = np.isin(np.arange(period), cover)
        chosen = is_cover[(place - first) % period] & (place + window - period + 1 <= last)
        chosen &= last - first >= window
        self.at = at = np.flatnonzero(chosen)
        self.doc = block.ids[self.owner[at]]
        # windows that hold the anchor's stretch start in low..high
        self.low = np.maximum(at - period + 1, first[at])
        self.high = np.minimum(at, last[at] - window)
        self.a = Rolling(words.hashes(0), 0)
        self.b = Rolling(words.hashes(1), 1)
        self.key = self.a.of(at, at + window - period + 1)
        # the surrounding and the anchor's place in it
        self.around = self.b.of(self.low, self.high + window) + (at - self.low).astype(np.uint64)
        pair = self.key ^ (self.around * np.uint64(0x9E3779B97F4A7C15))
        # documents ascend within a block, so a pair's first row has its smallest id
        _, self.first, self.pair = np.unique(pair, return_index=True, return_inverse=True)
        self.bucket_key = self.key[self.first]


def _pairs_reply(payloads: list[memoryview]) -> list[bytes]:
    """Per distinct (stretch, surrounding): its first document, and whether
    the stretch has other surroundings.  Rows with neither are left out."""
    parts = [B.unpack(p, "u8", "u8", "i8") for p in payloads]
    key, around, doc = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((doc, around, key))
    k, s, d = key[order], around[order], doc[order]
    new_key = np.ones(len(k), bool)
    new_key[1:] = k[1:] != k[:-1]
    new_pair = new_key.copy()
    new_pair[1:] |= s[1:] != s[:-1]
    at_pair, at_key = np.cumsum(new_pair) - 1, np.cumsum(new_key) - 1
    earliest = d[new_pair][at_pair]
    several = np.bincount(at_key[new_pair])[at_key] > 1
    out_first, out_several = np.empty_like(earliest), np.empty_like(several)
    out_first[order], out_several[order] = earliest, several
    replies, at = [], 0
    for part in parts:
        rows = slice(at, at + len(part[0]))
        at += len(part[0])
        say = np.flatnonzero((out_first[rows] < part[2]) | out_several[rows]).astype(np.int32)
        replies.append(B.pack(say, out_first[rows][say], out_several[rows][say]))
    return replies


def _windows_reply(payloads: list[memoryview]) -> list[bytes]:
    """The first document of each window that an earlier block row has."""
    parts = [B.unpack(p, "u8", "u8", "i8") for p in payloads]
    a, b, doc = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((doc, b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    first = np.empty_like(doc)
    first[order] = doc[order][new][np.cumsum(new) - 1]
    replies, at = [], 0
    for part in parts:
        rows = first[at : at + len(part[0])]
        at += len(rows)
        say = np.flatnonzero(rows < part[2]).astype(np.int32)
        replies.append(B.pack(say, rows[say]))
    return replies


class _Plan:
    """What a block derives again in every pass, always in the same order."""

    def __init__(self, window: int, period: int, cover: tuple[int, ...], buckets: int):
        self.window, self.period, self.cover, self.buckets = window, period, cover, buckets

    def anchors(self, block: B.Block) -> _Anchors:
        return _Anchors(block, self.window, self.period, self.cover)

    def ask_pairs(self, block: B.Block) -> Iterator[tuple[int, bytes]]:
        x = self.anchors(block)
        return B.split(
            B.to_buckets(x.bucket_key, self.buckets), x.bucket_key, x.around[x.first], x.doc[x.first]
        )

    def settled(self, block: B.Block, replies: dict[int, bytes]):
        """Anchors, windows known to start earlier, and windows to compare."""
        x = self.anchors(block)
        first_doc = x.doc[x.first].copy()
        several = np.zeros(len(first_doc), bool)
        bucket = B.to_buckets(x.bucket_key, self.buckets)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for k, payload in replies.items():
            if k < 0:  # replies of the other exchange
                continue
            at, first, branch = B.unpack(payload, "i4", "i8", "?")
            rows = order[starts[k] : starts[k + 1]][at]
            first_doc[rows], several[rows] = first, branch
        earlier = first_doc[x.pair] < x.doc
        n = len(x.words)
        known = _covered(x.low[earlier], x.high[earlier] + 1, n)
        extend = several[x.pair] & (first_doc[x.pair] == x.doc)
        compare = _covered(x.low[extend], x.high[extend] + 1, n) & ~known
        return x, known, np.flatnonzero(compare)

    def windows(self, x: _Anchors, at: np.ndarray, ids: np.ndarray):
        """Distinct windows to compare: hashes, first document, row of each."""
        a, b = x.a.of(at, at + self.window), x.b.of(at, at + self.window)
        _, first, pair = np.unique(a ^ (b * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_inverse=True)
        doc = ids[x.owner[at]]
        return a[first], b[first], doc[first], pair, doc

    def ask_windows(self, block: B.Block, replies: dict[int, bytes]) -> Iterator[tuple[int, bytes]]:
        x, _, at = self.settled(block, replies)
        a, b, doc, _, _ = self.windows(x, at, block.ids)
        return B.split(B.to_buckets(a, self.buckets), a, b, doc)

    def finish(self, block: B.Block, replies: dict[int, bytes]) -> pa.RecordBatch:
        x, known, at = self.settled(block, {k: v for k, v in replies.items() if k >= 0})
        a, _, first_doc, pair, doc = self.windows(x, at, block.ids)
        first_doc = first_doc.copy()
        bucket = B.to_buckets(a, self.buckets)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for k, payload in replies.items():
            if k >= 0:
                continue
            say, first = B.unpack(payload, "i4", "i8")
            first_doc[order[starts[-1 - k] : starts[-k]][say]] = first
        hits = np.flatnonzero(known)
        hits = np.concatenate([hits, at[first_doc[pair] < doc]])
        gone = _covered(hits, hits + self.window, len(x.words))
        return self.rows(block, x.words, gone)

    def rows(self, block: B.Block, words: Words, gone: np.ndarray) -> pa.RecordBatch:
        removed = np.concatenate([[0], np.cumsum(gone)])
        kept, data = [], block.data.tobytes()
        for i in range(len(block)):
            lo, hi = words.doc[i], words.doc[i + 1]
            if removed[hi] == removed[lo]:
                kept.append(b" ".join(data[block.offsets[i] : block.offsets[i + 1]].split()))
            else:
                at = lo + np.flatnonzero(~gone[lo:hi])
                kept.append(b" ".join([data[s:e] for s, e in zip(words.start[at], words.end[at])]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(block.ids),
                pa.array(np.diff(words.doc).astype(np.int64)),
                pa.array(np.diff(removed[words.doc]).astype(np.int64)),
                pa.array(kept, pa.binary()),
            ],
            names=["id", "n_words", "n_removed", "kept"],
        )


def _covered(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions in any of the stretches start..end-1."""
    edge = np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    period: int = PERIOD,
    cover: tuple[int, ...] = COVER,
) -> DataFrame:
    """One row per document: id, n_words, n_removed and ``kept``, the words
    left, joined by one space (UTF-8 bytes)."""
    if {(b - a) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("cover is no difference cover of the period")
    if period > window:
        raise ValueError("the period must not exceed the window")
    stored = B.store(docs, id_col, text_col)
    plan = _Plan(window, period, tuple(cover), stored.buckets)
    pairs = B.answer(B.ask(stored, plan.ask_pairs), _pairs_reply)
    pairs = scratch.written(pairs, "pairs")
    windows = B.answer(B.ask_again(stored, pairs, plan.ask_windows), _windows_reply)
    # replies of the second exchange are told apart by a negative bucket
    windows = windows.withColumn("bucket", -1 - F.col("bucket"))
    return B.with_answers(stored, pairs.unionByName(windows), plan.finish, RESULT)

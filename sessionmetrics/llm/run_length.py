"""Byte-level deduplication of long repeats with run-length indexes.

A byte is removed when a string of ``length`` bytes that covers it also starts
earlier: in a document with a smaller id, or earlier in the same one.

One index of the whole corpus would be one task's work, so the strings are
dealt out by content first.  Every string of ``length`` bytes belongs to one
anchor, the least hash of its substrings of ``seed_bytes`` bytes; equal
strings have equal anchors at the same place.

1. Every block sends its distinct (anchor, surrounding) pairs, the
   surrounding being all strings that belong to the anchor.  Buckets reply
   with the first place of each; a surrounding that occurs earlier is a copy
   altogether.  What is left are the first occurrences of surroundings whose
   anchor has several of them: the edges of repeats.
2. Those surroundings go to buckets by anchor, which build a run-length index
   of them (``RunIndex``): a Burrows-Wheeler transform compressed to runs,
   each run with its sample.  The surroundings are streamed backwards through
   the runs; a place whose match statistic reaches ``length`` with an earlier
   place is marked.
3. An anchor with more than ``CROWDED`` surroundings, such as a line that a
   third of all documents share amid different text, is no single index: its
   strings are compared one by one, hashed, each block sending each once.

Nulls and edges: a null text is empty; a row whose id is null is left out;
shorter texts keep everything; of rows repeated with one id neither starts
earlier at the same place, so they do not remove each other.  Hash equality
is decided on 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from . import scratch
from .text import Rolling, U, byte_symbols, ranges

LENGTH, SEED_BYTES = 100, 40
CROWDED = 1024
#: Bytes of the anchors indexed together (an anchor is never cut); an index
#: takes some 200 times that.
INDEX_BYTES = 1 << 19
RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept binary"
_PLACE_BITS = U(31)
_NOTES = -1


class _Anchors:
    """Strings of a block, grouped by the anchor they belong to."""

    def __init__(self, block: B.Block, length: int, seed_bytes: int):
        data, offsets = block.data, block.offsets
        self.a = Rolling(byte_symbols(0)[data], 0)
        self.b = Rolling(byte_symbols(1)[data], 1)
        size = np.diff(offsets) - 1  # without the space that follows a document
        count = np.maximum(size - length + 1, 0)
        q = ranges(offsets[:-1], count)
        seeds = self.a.windows(seed_bytes)
        least = (seeds >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(seeds), dtype=U)
        wide, span = 1, length - seed_bytes + 1
        while 2 * wide <= span:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        if wide < span:
            least = np.minimum(least[: len(least) - span + wide], least[span - wide :])
        place = (least[q] & ((U(1) << _PLACE_BITS) - U(1))).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:], len(place)) - 1
        self.at, self.low = place[first], q[first]
        self.high = q[last] if len(q) else q[:0]
        owner = np.searchsorted(offsets, self.at, side="right") - 1
        self.doc, self.pos = block.ids[owner], (self.at - offsets[owner]).astype(np.uint32)
        self.key = self.a.of(self.at, self.at + seed_bytes)
        self.around = self.b.of(self.low, self.high + length) + (self.at - self.low).astype(U)
        pair = self.key ^ (self.around * U(0x9E3779B97F4A7C15))
        order = np.arange(len(pair))
        if (np.diff(block.ids) <= 0).any():  # repeated ids: earlier places first
            order = np.lexsort((self.pos, self.doc))
        _, first, inverse = np.unique(pair[order], return_index=True, return_inverse=True)
        self.first = order[first]
        self.pair = np.empty_like(inverse)
        self.pair[order] = inverse


def _earlier(doc, pos, doc2, pos2):
    """Whether (doc, pos) is before (doc2, pos2)."""
    return (doc < doc2) | ((doc == doc2) & (pos < pos2))


def _groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by the columns (the last first), and starts of new values of the
    last one and of the last two."""
    order = np.lexsort(columns)
    top, second = columns[-1][order], columns[-2][order]
    new_top = np.ones(len(order), bool)
    new_top[1:] = top[1:] != top[:-1]
    new_pair = new_top.copy()
    new_pair[1:] |= second[1:] != second[:-1]
    return order, new_top, new_pair


_PAIR = ("u8", "u8", "i8", "u4")


def _pairs_reply(payloads: list[memoryview]) -> list[bytes]:
    """First place of each surrounding, and whether its anchor has several
    (1) or very many (2) surroundings; only rows that learn something."""
    parts = [B.unpack(p, *_PAIR) for p in payloads]
    key, around, doc, pos = (np.concatenate(x) for x in zip(*parts))
    order, new_key, new_pair = _groups(pos, doc, around, key)
    pair = np.cumsum(new_pair) - 1
    many = np.bincount((np.cumsum(new_key) - 1)[new_pair])[np.cumsum(new_key) - 1]
    first_doc, first_pos, several = np.empty_like(doc), np.empty_like(pos), np.empty(len(doc), np.int8)
    first_doc[order], first_pos[order] = doc[order][new_pair][pair], pos[order][new_pair][pair]
    several[order] = (many > 1).astype(np.int8) + (many > CROWDED)
    replies, at = [], 0
    for part in parts:
        rows = slice(at, at + len(part[0]))
        at += len(part[0])
        d, p = first_doc[rows], first_pos[rows]
        say = np.flatnonzero((several[rows] > 0) | _earlier(d, p, part[2], part[3])).astype(np.int32)
        replies.append(B.pack(say, d[say], p[say], several[rows][say]))
    return replies


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of many short strings.

    ``text`` holds the strings one after the other, ``ends`` the end of each.
    Suffixes are sorted within their string; equal ones by their place.  Rows
    of the transform with one preceding symbol, whose suffixes agree with
    their neighbours on ``length`` bytes, form a run.  A run keeps its symbol,
    its first row, the row that its first row leads to (so that any of its
    rows leads to the row as far behind), and as sample the first of all
    suffixes that agree on ``length`` bytes, where there are that many.
    ``order`` says which suffix is earlier, by default the one further left.
    """

    def __init__(self, text: np.ndarray, ends: np.ndarray, length: int, order: np.ndarray | None = None):
        n = len(text)
        self.order = np.arange(n) if order is None else order
        self.length = length
        end_of = np.repeat(ends, np.diff(ends, prepend=0))
        place = np.arange(n)
        rank, width = self._packed(text, end_of), 7
        at_half = None
        longest = int(np.diff(ends, prepend=0).max(initial=1))
        half = max(7, 7 << int(np.log2(max(1, length / 7))))  # largest doubled width within length
        while True:
            if width == half:
                at_half = rank
            if width >= max(longest, half):
                break
            # the rank of what follows; 0 past the end of the string
            behind = place + width
            later = np.where(behind < end_of, rank[np.minimum(behind, n - 1)] + 1, 0)
            _, rank = np.unique(rank * (n + 1) + later, return_inverse=True)
            width *= 2
        rows = np.argsort(rank, kind="stable")  # equal suffixes by place
        before = np.full(n, -1)  # symbol before each suffix, -1 at the start of a string
        before[1:] = text[:-1]
        before[np.concatenate([[0], ends[:-1]])] = -1
        symbol = before[rows]
        # neighbours that agree on ``length`` bytes: two overlapping stretches of ``half``
        enough = (end_of - place >= length)[rows]
        one, two = at_half[rows], at_half[np.minimum(rows + length - half, n - 1)]
        agree = np.zeros(n, bool)
        agree[1:] = (one[1:] == one[:-1]) & (two[1:] == two[:-1]) & enough[1:] & enough[:-1]
        group = np.cumsum(~agree) - 1
        least = np.minimum.reduceat(self.order[rows], np.flatnonzero(~agree))
        head = ~agree
        head[1:] |= symbol[1:] != symbol[:-1]
        self.start = np.flatnonzero(head)
        self.symbol = symbol[self.start]
        self.sample = np.where(enough[self.start], least[group[self.start]], -1)
        # Suffixes that begin with one symbol are neighbours: first those of
        # one symbol, the ends of strings, then as the rows they lead from.
        lengths = np.diff(np.append(self.start, n))
        by_symbol = np.argsort(self.symbol, kind="stable")
        before_run = np.empty(len(lengths), np.int64)
        before_run[by_symbol] = np.cumsum(lengths[by_symbol]) - lengths[by_symbol]
        used = np.bincount(text, minlength=256)
        single = np.bincount(text[ends - 1], minlength=256)
        of_symbol = np.bincount(self.symbol + 1, lengths, minlength=257).astype(np.int64)
        shift = np.cumsum(used) - used + single - np.cumsum(of_symbol)[:-1]
        self.leads = before_run + shift[self.symbol]  # unused at the start of a string
        row_of = np.empty(n, np.int64)
        row_of[rows] = place
        self.last_rows = row_of[ends - 1]

    @staticmethod
    def _packed(text: np.ndarray, end_of: np.ndarray) -> np.ndarray:
        """Ranks by the next 7 bytes, cut at the string's end."""
        n = len(text)
        key = np.zeros(n, np.int64)
        place = np.arange(n)
        for k in range(7):
            inside = place + k < end_of
            key = key << 8 | np.where(inside, text[np.minimum(place + k, n - 1)], 0)
        key = key << 3 | np.minimum(end_of - place, 7)
        return np.unique(key, return_inverse=True)[1]

    def repeats(self, ends: np.ndarray) -> np.ndarray:
        """Stream all strings backwards through the runs, side by side: mask
        of the places whose next ``length`` bytes start at an earlier place."""
        starts = np.concatenate([[0], ends[:-1]])
        out = np.zeros(int(ends[-1]) if len(ends) else 0, bool)
        row, place = self.last_rows, ends - 1
        live = np.arange(len(ends))
        while len(live):
            run = np.searchsorted(self.start, row, side="right") - 1
            out[place] = (self.sample[run] >= 0) & (self.sample[run] < self.order[place])
            on = place > starts[live]
            # step to the left: all rows of a run lead on side by side
            row = (self.leads[run] + row - self.start[run])[on]
            place, live = place[on] - 1, live[on]
        return out


def _edges_reply(payloads: list[memoryview], length: int) -> list[bytes]:
    """Marked places in the surroundings of each payload.  Anchors do not
    meet, so they are indexed some at a time."""
    parts = []
    for p in payloads:
        key, doc, pos, size = B.unpack(p, "u8", "i8", "u4", "i8")
        body = np.frombuffer(p, np.uint8)[8 + 28 * len(doc) :]
        parts.append((key, doc, pos, size, body))
    key, doc, pos, size, body = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((pos, doc, key))
    start = np.cumsum(size) - size
    # places in the corpus: the document's rank, then the byte in it
    rank = np.unique(doc, return_inverse=True)[1]
    begins = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]))
    index = (np.cumsum(size[order])[begins] - size[order][begins]) // INDEX_BYTES
    cuts = begins[np.flatnonzero(np.diff(index, prepend=-1))]
    marked = np.zeros(len(body), bool)
    for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
        rows = order[lo:hi]
        source, ends = ranges(start[rows], size[rows]), np.cumsum(size[rows])
        place = np.repeat((rank[rows] << 32) + pos[rows], size[rows])
        place += ranges(np.zeros(len(rows), np.int64), size[rows])
        marked[source] = RunIndex(body[source], ends, length, place).repeats(ends)
    cuts = np.cumsum([len(p[4]) for p in parts])
    return [B.pack(np.flatnonzero(m).astype(np.int32)) for m in np.split(marked, cuts[:-1])]


def _strings_reply(payloads: list[memoryview]) -> list[bytes]:
    """Which strings of each payload occur earlier."""
    parts = [B.unpack(p, *_PAIR) for p in payloads]
    a, b, doc, pos = (np.concatenate(x) for x in zip(*parts))
    order, _, new = _groups(pos, doc, b, a)
    which = np.cumsum(new) - 1
    later = np.zeros(len(a), bool)
    later[order] = _earlier(doc[order][new][which], pos[order][new][which], doc[order], pos[order])
    cuts = np.cumsum([len(p[0]) for p in parts])
    return [B.pack(np.flatnonzero(m).astype(np.int32)) for m in np.split(later, cuts[:-1])]


class _Plan:
    def __init__(self, length: int, seed_bytes: int, buckets: int):
        self.length, self.seed_bytes, self.buckets = length, seed_bytes, buckets

    def ask_pairs(self, block: B.Block) -> Iterator[tuple[int, bytes]]:
        x = _Anchors(block, self.length, self.seed_bytes)
        f = x.first
        return B.split(B.to_buckets(x.key[f], self.buckets), x.key[f], x.around[f], x.doc[f], x.pos[f])

    def ask_edges(self, block: B.Block, replies: dict[int, bytes]) -> Iterator[tuple[int, bytes]]:
        """Buckets 0.. get surroundings, buckets ``self.buckets``.. single
        strings; the block's notes for itself say where those stand."""
        x = _Anchors(block, self.length, self.seed_bytes)
        f = x.first
        doc, pos, several = x.doc[f].copy(), x.pos[f].copy(), np.zeros(len(f), np.int8)
        bucket = B.to_buckets(x.key[f], self.buckets)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for k, payload in replies.items():
            say, d, p, many = B.unpack(payload, "i4", "i8", "u4", "i1")
            rows = order[starts[k] : starts[k + 1]][say]
            doc[rows], pos[rows], several[rows] = d, p, many
        copy = _earlier(doc[x.pair], pos[x.pair], x.doc, x.pos)
        # the block with the first occurrence of a surrounding speaks for it
        own = np.zeros(len(x.at), bool)
        own[f] = (doc == x.doc[f]) & (pos == x.pos[f])
        edge = np.flatnonzero(own & (several[x.pair] == 1))
        crowd = np.flatnonzero(own & (several[x.pair] == 2))
        same = ~copy & ~own & (several[x.pair] > 0)  # same place of a repeated id
        notes = [x.low[copy], x.high[copy]]
        twins = np.flatnonzero(same)
        edge, crowd = (np.concatenate([e, twins[several[x.pair][twins] == s]]) for e, s in ((edge, 1), (crowd, 2)))

        def parts():
            stand, cells = [], B.to_buckets(x.key[edge], self.buckets)
            by = np.argsort(cells, kind="stable")
            cuts = np.flatnonzero(np.diff(cells[by], prepend=-1))
            for lo, hi in zip(cuts, [*cuts[1:], len(by)]):
                e = edge[by[lo:hi]]
                size = x.high[e] + self.length - x.low[e]
                body = block.data[ranges(x.low[e], size)]
                start = (x.pos[e] - (x.at[e] - x.low[e])).astype(np.uint32)
                yield int(cells[by[lo]]), B.pack(x.key[e], x.doc[e], start, size) + body.tobytes()
                stand.append((int(cells[by[lo]]), x.low[e], size))
            q = ranges(x.low[crowd], x.high[crowd] - x.low[crowd] + 1)
            who = np.repeat(crowd, x.high[crowd] - x.low[crowd] + 1)
            a, b = x.a.of(q, q + self.length), x.b.of(q, q + self.length)
            cells = B.to_buckets(a, self.buckets) + self.buckets
            yield from B.split(cells, a, b, x.doc[who], x.pos[who])
            by = np.argsort(cells, kind="stable")
            cuts = np.flatnonzero(np.diff(cells[by], prepend=-1))
            for lo, hi in zip(cuts, [*cuts[1:], len(by)]):
                at = q[by[lo:hi]]
                stand.append((int(cells[by[lo]]), at, np.ones(len(at), np.int64)))
            yield _NOTES, b"".join([
                B.pack(*notes),
                *(B.pack(np.full(len(low), k, np.int64), low, size) for k, low, size in stand),
            ])

        return parts()

    def finish(self, block: B.Block, replies: dict[int, bytes]) -> pa.RecordBatch:
        notes = replies[_NOTES]
        low, high = B.unpack(notes, "i8", "i8")
        at = 8 + 16 * len(low)
        begin, stop = [low], [high + self.length]
        while at < len(notes):
            cell, first, size = B.unpack(notes[at:], "i8", "i8", "i8")
            at += 8 + 24 * len(cell)
            place = ranges(first, size)[B.unpack(replies[-2 - int(cell[0])], "i4")[0]]
            begin.append(place)
            stop.append(place + self.length)
        n = len(block.data)
        edge = np.bincount(np.concatenate(begin), minlength=n + 1) - np.bincount(np.concatenate(stop), minlength=n + 1)
        gone = np.cumsum(edge[:n]) > 0
        return self.rows(block, gone)

    def rows(self, block: B.Block, gone: np.ndarray) -> pa.RecordBatch:
        lo, hi = block.offsets[:-1], block.offsets[1:] - 1
        total = np.concatenate([[0], np.cumsum(gone)])
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        begins[lo] = gone[lo]
        spans = np.concatenate([[0], np.cumsum(begins)])
        kept = [
            block.data[a:b].tobytes() if total[a] == total[b] else block.data[a:b][~gone[a:b]].tobytes()
            for a, b in zip(lo, hi)
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(block.ids), pa.array(hi - lo), pa.array(total[hi] - total[lo]),
                pa.array(spans[hi] - spans[lo]), pa.array(kept, pa.binary()),
            ],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed_bytes: int = SEED_BYTES,
    block_bytes: int = B.BLOCK_BYTES,
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans (maximal removed
    runs) and ``kept``, the bytes left."""
    if not 0 < seed_bytes <= length:
        raise ValueError("seed_bytes must be in 1..length")
    stored = B.store(docs, id_col, text_col, block_bytes)
    plan = _Plan(length, seed_bytes, stored.buckets)
    pairs = B.answer(B.ask(stored, plan.ask_pairs), _pairs_reply)
    edges = scratch.written(B.ask_again(stored, pairs, plan.ask_edges), "edges-of-repeats")
    n = stored.buckets

    def reply(payloads: list[memoryview], bucket: int) -> list[bytes]:
        return _edges_reply(payloads, length) if bucket < n else _strings_reply(payloads)

    answers = B.answer_by_bucket(edges.where(F.col("bucket") >= 0), reply)
    answers = answers.withColumn("bucket", -2 - F.col("bucket"))
    notes = edges.where(F.col("bucket") == _NOTES)
    return B.with_answers(stored, notes.unionByName(answers), plan.finish, RESULT)

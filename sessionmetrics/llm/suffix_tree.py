"""Language-model scores from a probabilistic suffix tree over words.

A state is a context of up to ``DEPTH`` preceding words.  The root is the
smoothed unigram distribution ``(c + 1) / (N + V + 1)``.  A context that
occurs ``min_context`` times in the training texts is a candidate; its
next-symbol distribution is smoothed by absolute discounting into that of its
longest retained suffix:

    P(y | s) = max(n(s, y) - DISCOUNT, 0) / n(s) + rest(s) * P(y | suffix of s)

where only pairs with ``n >= LISTED`` have an entry of their own.  The
candidate is retained when it diverges from its suffix: the training
occurrences, each left out of its own estimate, must gain ``min_gain`` nats of
likelihood in all.  A word is scored by the longest retained suffix of its
history, so every state is a proper distribution over words.

The tree is nowhere in one piece.  Every block asks for what its own texts
need: counts of its distinct words, then statistics of its distinct
(context, next word) pairs, one depth after the other; buckets add up what
all blocks send, apply the test and reply.  A word or pair that a third of
all documents hold is one row per block.  What is gathered grows with the
corpus; nothing of it goes to the driver but two totals.

Words are told apart by 64-bit hashes (SipHash).  A word's bucket gives it a
number; then the blocks are stored once more as these numbers, and the texts
and the words' replies, which nothing reads any longer, are removed.  Contexts
and pairs are tuples of numbers, without further hashing: sorted, as differences and compressed, they take a fraction of a
hash's bytes, since frequent words have small numbers.  Replies hold retained
contexts, and pairs of these or that may be contexts themselves.  Counts are
64 bits wide everywhere.  Words that occur less than ``min_next`` times in training have no
entry of their own in longer contexts.  Both thresholds are numbers of
occurrences, the same at every size: the tree grows with the corpus, and the
divergence test decides what is retained.  All pairs of one context meet in
one bucket.

Nulls and edges: a null or empty text has one token, the end; a row whose id
is null is left out; repeated rows are scored, and learned from, as often as
they occur; without training texts every count is zero and V is zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from . import scratch
from .text import U, Words, distinct, mix, order_by, ranges

DEPTH = 2
MIN_CONTEXT, MIN_NEXT, LISTED = 8, 2, 2
DISCOUNT = 0.75
MIN_GAIN = 16.0
#: Larger blocks ask for fewer of the same words and pairs.
BLOCK_BYTES = 4 << 20
_END = U(0x656E645F6F665F74)
_FIXED = 2000.0  # log-probabilities travel in units of 1/2000 nat
RESULT = (
    "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double, n_states long"
)


class _Tokens:
    """Words and ends of a block's documents, and the block's distinct ones."""

    def __init__(self, block: B.Block, held_out: Callable[[np.ndarray], np.ndarray]):
        words = Words(block.data, block.offsets)
        hashed, word = words.distinct(0, lower=True)
        self.first = words.doc[:-1] + np.arange(len(block))
        self.size = np.diff(words.doc) + 1
        self.held_out = held_out(block.ids)
        self.train = np.repeat(~self.held_out, self.size)
        self.distinct, place = np.unique(np.append(hashed, _END), return_inverse=True)
        self.word = place[np.insert(word, words.doc[1:], len(hashed))]


class _Numbered:
    """A block's tokens as ``_Plan.numbered`` stores them: places in the list of
    its distinct words, whose numbers ascend (0, after those, for words
    without one), and how often these occur in training."""

    def __init__(self, block: B.Block, held_out: Callable[[np.ndarray], np.ndarray]):
        self.first, self.size = block.offsets[:-1], np.diff(block.offsets)
        self.held_out = held_out(block.ids)
        self.train = np.repeat(~self.held_out, self.size)
        steps, n_words, word = (column.view(np.int64) for column in B.unsqueeze(block.data))
        self.n_words, self.word = n_words, word
        self.number = np.zeros(len(n_words), np.int64)
        self.number[: len(steps)] = np.cumsum(steps)
        self.place = np.arange(len(word)) - np.repeat(self.first, self.size)


def _words_reply(payloads: list[memoryview], named: int) -> list[bytes]:
    """Training occurrences of each word, and a number from 1 up for each word
    with ``named`` of them, frequent words first; the first reply also carries
    the bucket's numbers of tokens and of words seen in training."""
    parts = [B.unsqueeze(p) for p in payloads]
    word = np.concatenate([np.cumsum(p[0]) for p in parts])
    n = np.concatenate([p[1] for p in parts])
    names, at = np.unique(word, return_inverse=True)
    total = _sums_by(at, n, len(names))
    number = np.zeros(len(names), np.int64)
    number[np.lexsort((names, -total))] = np.arange(1, len(names) + 1)
    number[total < named] = 0
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    replies = [B.squeeze(t, i) for t, i in zip(np.split(total[at], cuts), np.split(number[at], cuts))]
    summary = np.array([total.sum(), (total > 0).sum()], np.int64).tobytes()
    return [summary + replies[0], *(bytes(16) + r for r in replies[1:])]


def _sums_by(at: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers, exact beyond what a double holds."""
    out = np.zeros(size, np.int64)
    np.add.at(out, at, n.astype(np.int64))
    return out


def _differences(column: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Steps of an ascending column that starts anew at ``starts``."""
    steps = np.diff(column, prepend=column[:1] * 0)
    if starts is not None:
        steps[starts] = column[starts]
    return steps


def _ascending(steps: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The column whose ``_differences`` are ``steps``, groups of ``many``."""
    total = np.cumsum(steps.astype(np.int64))
    starts = (np.cumsum(many) - many)[many > 0]
    return total - np.repeat(total[starts] - steps[starts].astype(np.int64), many[many > 0])


def _groups(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct row of ``columns``, and a row of each."""
    order = order_by(*columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns:
        there = column[order]
        new[1:] |= there[1:] != there[:-1]
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    return at, order[new]


def _rest(seen: np.ndarray, entries: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What the entries of contexts, ``seen`` times in all, leave for their suffixes."""
    return 1 - (seen - DISCOUNT * entries) / np.maximum(size, 1)


def _pairs_reply(payloads: list[memoryview], min_gain: float, min_longer: int | None) -> list[bytes]:
    """Number and occurrences of the entries of each retained context, and the
    training occurrences of each pair: 0 where the block has no use for them,
    that is unless the context is retained or the pair, with ``min_longer``
    occurrences, is a context itself."""
    parts = []
    for p in payloads:
        many, count, first, *others, steps, n, log_p = B.unsqueeze(p)
        many = many.astype(np.int64)
        context = [np.cumsum(first.astype(np.int64)), *others]
        following = _ascending(steps, many)
        if not others:
            log_p = log_p[distinct(following)[2]]
        parts.append((many, count, *context, following, n, log_p))
    many, count, *context, following, n, log_p = (np.concatenate(x) for x in zip(*parts))
    sizes = [(len(p[0]), len(p[-1])) for p in parts]
    del parts
    at, sample = _groups([c.astype(np.int64) for c in context])
    size = count[sample].astype(float)
    own = np.repeat(at, many)
    order = order_by(following, own)
    own, following = own[order], following[order]
    new = np.ones(len(order), bool)
    new[1:] = (own[1:] != own[:-1]) | (following[1:] != following[:-1])
    pair = np.empty(len(order), np.int64)
    pair[order] = np.cumsum(new) - 1
    holder = own[new]
    first = np.flatnonzero(new)
    total, below = np.zeros(0, np.int64), np.zeros(0)
    if len(first):
        total = np.add.reduceat(n[order].astype(np.int64), first)
        # blocks that did not see a pair in training send no probability
        below = np.maximum.reduceat(log_p[order], first).astype(float)
    listed = total >= LISTED
    below = np.exp(below[listed] / -_FIXED)
    s = holder[listed]
    entries = np.bincount(s, minlength=len(size))
    seen = _sums_by(s, total[listed], len(size))
    rest = _rest(seen, entries, size)
    # every occurrence judged by the estimate without it
    without = np.maximum(total[listed] - 1 - DISCOUNT, 0) / np.maximum(size[s] - 1, 1) + rest[s] * below
    gain = np.bincount(s, total[listed] * np.log(without / below), minlength=len(size))
    gain += (size - seen) * np.log(np.maximum(rest, 1e-9))
    retained = gain >= min_gain
    used = listed & retained[holder]
    if min_longer is not None:
        used |= listed & (total >= min_longer)
    shown = np.where(used, total, 0)[pair]
    replies, c, k = [], 0, 0
    for n_contexts, n_pairs in sizes:
        rows = at[c : c + n_contexts]
        held = np.flatnonzero(retained[rows])
        own = rows[held]
        replies.append(B.squeeze(_differences(held), seen[own], entries[own], shown[k : k + n_pairs]))
        c, k = c + n_contexts, k + n_pairs
    return replies


class _Plan:
    def __init__(self, buckets: int, held_out, min_context: int, min_next: int):
        self.buckets, self.held_out = buckets, held_out
        self.min_context, self.min_next = min_context, min_next
        # known after the first exchange
        self.tokens, self.vocabulary = 0, 0

    def _words(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words in order of their buckets, and each bucket's start in it."""
        bucket = B.to_buckets(mix(names), self.buckets)
        order = order_by(bucket)
        return order, np.searchsorted(bucket[order], np.arange(self.buckets + 1))

    def _contexts(self, names: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The same of contexts, which ascend and do so in each bucket."""
        key = np.zeros(len(names[0]), U)
        for column in names:
            key = mix(key * U(0x9E3779B97F4A7C15) + column.astype(U))
        bucket = B.to_buckets(key, self.buckets)
        order = order_by(bucket)
        return order, np.searchsorted(bucket[order], np.arange(self.buckets + 1))

    def ask_words(self, block: B.Block) -> Iterator[tuple[int, bytes]]:
        t = _Tokens(block, self.held_out)
        n = np.bincount(t.word[t.train], minlength=len(t.distinct))
        order, starts = self._words(t.distinct)
        for k in range(self.buckets):
            rows = order[starts[k] : starts[k + 1]]
            if len(rows):
                yield k, B.squeeze(_differences(t.distinct[rows]), n[rows])

    def numbered(self, block: B.Block, replies: dict[int, bytes]) -> pa.RecordBatch:
        """The block with its words' numbers in place of its texts."""
        t = _Tokens(block, self.held_out)
        n_words = np.zeros(len(t.distinct), np.int64)
        number = np.zeros(len(t.distinct), np.int64)
        order, starts = self._words(t.distinct)
        for k in range(self.buckets):
            rows = order[starts[k] : starts[k + 1]]
            if len(rows):
                n_words[rows], place = B.unsqueeze(replies[k][16:])
                # one number for each word of the corpus, frequent words first
                number[rows] = np.where(place > 0, (place.astype(np.int64) - 1) * self.buckets + k + 1, 0)
        order = order_by(number, number == 0)
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(order))
        ascending = number[order][: np.count_nonzero(number)]
        data = B.squeeze(_differences(ascending), n_words[order], at[t.word])
        offsets = np.append(t.first, len(t.word)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block.block], pa.int64()), pa.array([block.ids.tobytes()], pa.binary()),
                pa.array([offsets.tobytes()], pa.binary()), pa.array([data], pa.binary()),
            ],
            names=["block", "ids", "offsets", "data"],
        )

    def ask_pairs(self, block: B.Block, replies: dict[int, bytes], depth: int) -> Iterator[tuple[int, bytes]]:
        """Statistics of the contexts of ``depth`` words."""
        state = _State(self, block, replies, depth - 1, ask=True)
        names, many, count, following, n, log_p = state.asked
        order, starts = self._contexts(names)
        begin = np.cumsum(many) - many
        for k in range(self.buckets):
            rows = order[starts[k] : starts[k + 1]]
            if len(rows):
                m = many[rows]
                at = ranges(begin[rows], m)
                steps = _differences(following[at], (np.cumsum(m) - m)[m > 0])
                first, *others = (c[rows] for c in names)
                below = log_p[at]
                if depth == 1:  # by the next word alone: once for each
                    below = below[np.unique(following[at], return_index=True)[1]]
                yield k, B.squeeze(m, count[rows], _differences(first), *others, steps, n[at], below)

    def finish(self, block: B.Block, replies: dict[int, bytes], depth: int) -> pa.RecordBatch:
        state = _State(self, block, replies, depth)
        t = state.tokens
        log10 = np.log(10.0)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(block.ids), pa.array(t.held_out), pa.array(t.size),
                pa.array(np.add.reduceat((state.count > 0).astype(np.int64), t.first)),
                pa.array(np.full(len(block), self.tokens, np.int64)),
                pa.array(np.add.reduceat(state.root, t.first) / log10),
                pa.array(np.add.reduceat(state.log_p, t.first) / log10),
                pa.array(np.add.reduceat((state.level > 0).astype(np.int64), t.first)),
            ],
            names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_states"],
        )


class _State:
    """A block's tokens with all that replies up to ``depth`` say: ``log_p`` by
    the longest retained suffix, ``count`` of each token and, with ``ask``,
    what to ask for contexts one word longer."""

    def __init__(self, plan: _Plan, block: B.Block, replies: dict[int, bytes], depth: int, ask: bool = False):
        self.tokens = t = _Numbered(block, plan.held_out)
        number, n_words = t.number, t.n_words
        self.count = n_words[t.word]
        self.root = np.log((n_words + 1.0) / (plan.tokens + plan.vocabulary + 1))[t.word]
        self.log_p = self.root.copy()
        self.level = np.zeros(len(self.count), np.int8)
        entry = n_words >= plan.min_next
        # the history of a token: the words before it, and how often those
        # occur in training
        names, times = [number], n_words
        at = np.flatnonzero(t.place >= 1)
        before = t.word[at - 1]
        for d in range(1, depth + 1 + ask):
            ok = times[before] >= plan.min_context
            at, before = at[ok], before[ok]
            there = np.zeros(len(times), bool)
            there[before] = True
            used, context = np.flatnonzero(there), (np.cumsum(there) - 1)[before]
            own = [column[used] for column in names]
            following = t.word[at]
            asks = np.flatnonzero(entry[following])
            asked, following, holder = at[asks], following[asks], context[asks]
            # words with an entry have numbers, which ascend as their places do
            _, sample, which = distinct(holder * np.int64(len(number)) + following)
            holder, word = holder[sample], following[sample]
            many = np.bincount(holder, minlength=len(used)).astype(np.int64)
            if d > depth:
                n = np.bincount(which[t.train[asked]], minlength=len(sample))
                log_p = np.round(-self.log_p[asked[sample]] * _FIXED).astype(np.int64)
                # a pair's probability by a shorter context is known where it was seen
                self.asked = (own, many, times[used], number[word], n, log_p if d == 1 else np.where(n > 0, log_p, 0))
                return
            rest, seen = self._replied(plan, replies, d, own, many, times[used])
            self._apply(t, at, context, asks, which, rest, seen, times[used], d)
            # contexts one word longer: this pair, if it is frequent
            names, times = [*(column[holder] for column in own), number[word]], seen
            if not len(times):  # no context is frequent enough: nothing longer either
                names, times = [np.zeros(1, np.int64)] * (d + 1), np.zeros(1, np.int64)
            longer = np.full(len(t.word) + 1, -1)
            longer[asked + 1] = which
            at = np.flatnonzero((t.place >= d + 1) & (longer[:-1] >= 0))
            before = longer[at]

    @staticmethod
    def _replied(plan: _Plan, replies: dict[int, bytes], d: int, names: list[np.ndarray], many: np.ndarray, size: np.ndarray):
        rest, seen = np.full(len(names[0]), np.nan), np.zeros(int(many.sum()), np.int64)
        order, starts = plan._contexts(names)
        begin = np.cumsum(many) - many
        for k in range(plan.buckets):
            rows = order[starts[k] : starts[k + 1]]
            if len(rows):
                held, total, entries, shown = B.unsqueeze(replies[d * plan.buckets + k])
                held = rows[np.cumsum(held).astype(np.int64)]
                rest[held] = _rest(total.astype(float), entries.astype(float), size[held])
                seen[ranges(begin[rows], many[rows])] = shown
        return rest, seen

    def _apply(self, t, at, context, asks, which, rest, seen, size, d) -> None:
        n = np.zeros(len(at))
        n[asks] = seen[which]
        held = np.flatnonzero(~np.isnan(rest)[context])
        at, context, n = at[held], context[held], n[held]
        p = np.maximum(n - DISCOUNT, 0) * (n >= LISTED) / size[context] + rest[context] * np.exp(self.log_p[at])
        self.log_p[at] = np.log(p)
        self.level[at] = d


def score(
    docs: DataFrame, held_out: Callable[[np.ndarray], np.ndarray], id_col: str = "doc_id", text_col: str = "text",
    depth: int = DEPTH, min_gain: float = MIN_GAIN, min_context: int = MIN_CONTEXT, min_next: int = MIN_NEXT,
) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens,
    base_score (root state alone), score, n_states (tokens scored by a longer
    state).  ``held_out(ids)`` marks the documents not to learn from."""
    with scratch.owned() as texts:
        stored = B.store(docs, id_col, text_col, BLOCK_BYTES)
        plan = _Plan(stored.buckets, held_out, min_context, min_next)
        named = min(min_context, min_next)
        words = B.answer(B.ask(stored, plan.ask_words), lambda payloads: _words_reply(payloads, named))
        words = B.kept_by_block(stored, words)
    # the two totals, added up from one summary per bucket
    summary = words.select(F.explode("replies").alias("r")).select(F.substring("r.payload", 1, 16).alias("summary"))
    summary = summary.mapInArrow(_sums, "tokens long, words long")
    totals = summary.agg(F.sum("tokens"), F.sum("words")).first()
    plan.tokens, plan.vocabulary = int(totals[0] or 0), int(totals[1] or 0)
    stored = B.rewritten(stored, [words], plan.numbered)
    texts.remove(docs.sparkSession)
    n, known = stored.buckets, []
    for d in range(1, depth + 1):
        asked = B.ask_joined(stored, known, lambda b, r, d=d: plan.ask_pairs(b, r, d))
        longer = min_context if d < depth else None
        replied = B.answer(asked, lambda p, longer=longer: _pairs_reply(p, min_gain, longer))
        known.append(B.kept_by_block(stored, replied.withColumn("bucket", F.col("bucket") + F.lit(d * n))))
    return B.joined(stored, known, lambda b, r: plan.finish(b, r, depth), RESULT)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(2, np.int64)
    for batch in batches:
        for value in B.column_bytes(batch.column(0)):
            total += np.frombuffer(value, np.int64, 2)
    yield pa.RecordBatch.from_arrays([pa.array(total[:1]), pa.array(total[1:])], names=["tokens", "words"])

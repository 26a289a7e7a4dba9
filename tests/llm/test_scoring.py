"""Suffix-tree scores (1) against a plain tree in dictionaries."""

from __future__ import annotations

import math
import os
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import edge_rows
from sessionmetrics.llm import scratch, suffix_tree
from sessionmetrics.llm.queries import _remainder_is_two

END = "<end>"


def _brute(rows, depth, min_context, min_next, min_gain):
    docs = [(r[0], edge_rows.as_bytes(r[1]).lower().split() + [END]) for r in rows if r[0] is not None]
    train = [w for d, w in docs if not edge_rows.crc_is_two(d, 7)]
    count = Counter(x for w in train for x in w)
    n, v = sum(count.values()), len(count)
    follow: dict = defaultdict(Counter)
    for w in train:
        for i in range(len(w)):
            for k in range(1, depth + 1):
                if i >= k:
                    follow[tuple(w[i - k : i])][w[i]] += 1
    # a longer context is known by its last pair, which needs an entry of its own
    def occurrences(context):
        if len(context) == 1:
            return count[context[0]]
        shorter, last = context[:-1], context[-1]
        if occurrences(shorter) < min_context or count[last] < min_next:
            return 0
        seen = follow[shorter][last]
        return seen if seen >= suffix_tree.LISTED else 0

    states: dict = {}

    def p(word, history):
        for k in range(min(depth, len(history)), 0, -1):
            s = tuple(history[-k:])
            if s in states:
                kept, size, rest = states[s]
                own = max(kept.get(word, 0) - suffix_tree.DISCOUNT, 0) / size if word in kept else 0.0
                return own + rest * p(word, history[-(k - 1) :] if k > 1 else [])
        return (count[word] + 1) / (n + v + 1)

    for k in range(1, depth + 1):
        for s in [s for s in follow if len(s) == k]:
            size = occurrences(s)
            if size < min_context:
                continue
            kept = {w: c for w, c in follow[s].items() if c >= suffix_tree.LISTED and count[w] >= min_next}
            rest = 1 - sum(c - suffix_tree.DISCOUNT for c in kept.values()) / size
            gain = (size - sum(kept.values())) * math.log(max(rest, 1e-9))
            for w, c in kept.items():
                below = p(w, list(s[1:]))
                without = max(c - 1 - suffix_tree.DISCOUNT, 0) / (size - 1) + rest * below
                gain += c * math.log(without / below)
            if gain >= min_gain:
                states[s] = (kept, size, rest)
    out = {}
    for d, w in docs:
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)
        score = sum(math.log10(p(x, w[:i])) for i, x in enumerate(w))
        out[d] = (edge_rows.crc_is_two(d, 7), len(w), sum(count[x] > 0 for x in w), n, base, score)
    return out, len(states)


def _rows():
    extra = [edge_rows.row(500 + i, edge_rows.words(i, 120, 12)) for i in range(25)]
    return [r for r in edge_rows.documents() if r[0] not in (30, 31)] + extra


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_scores_match_brute_force(session, depth):
    rows = _rows()
    df = session.createDataFrame(rows, edge_rows.SCHEMA).repartition(3)
    got = suffix_tree.score(
        df, lambda ids: _remainder_is_two(ids, 7), depth=depth, min_context=8, min_next=4, min_gain=2.0
    ).collect()
    want, states = _brute(rows, depth, 8, 4, 2.0)
    assert states > 10
    assert len(got) == sum(r[0] is not None for r in rows)
    for r in got:
        held, n, known, total, base, score = want[r.id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, rel=2e-3)  # probabilities travel in steps of 1/2000 nat
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_all_edge_documents(edge_docs):
    got = suffix_tree.score(edge_docs, lambda ids: _remainder_is_two(ids, 7)).collect()
    by_id = {r.id: r for r in got}
    assert by_id[1].n_tokens == 1 and by_id[2].n_tokens == 1 and by_id[4].n_tokens == 1
    assert by_id[30].n_tokens == 60_001
    assert len(got) == sum(r[0] is not None for r in edge_rows.documents())


def test_nothing_to_learn_from(session):
    df = session.createDataFrame([edge_rows.row(1, "a b")], edge_rows.SCHEMA)
    got = suffix_tree.score(df, lambda ids: ids == ids).first()
    assert (got.held_out, got.n_tokens, got.n_known, got.train_tokens) == (True, 3, 0, 0)
    assert got.base_score == 0.0  # (0 + 1) / (0 + 0 + 1)


def test_no_documents(no_docs):
    assert suffix_tree.score(no_docs, lambda ids: ids == ids).collect() == []


def test_thresholds_do_not_rise_with_the_corpus(session):
    """Nine occurrences make a state among millions of other words, too."""
    rare = [edge_rows.row(1000 + i, "alpha beta") for i in range(40)]
    rare = [r for r in rare if not edge_rows.crc_is_two(r[0], 7)][:9]
    much = session.range(48).select(
        F.col("id").alias("doc_id"), F.expr("repeat('x ', 120000)").alias("text")
    )
    df = session.createDataFrame(rare, edge_rows.SCHEMA).select("doc_id", "text").unionByName(much).repartition(3)
    got = {r.id: r for r in suffix_tree.score(df, lambda ids: _remainder_is_two(ids, 7)).collect()}
    for row in rare:
        r = got[row[0]]
        assert r.train_tokens > 3_000_000
        assert r.n_states == 2  # beta after alpha, the end after beta
        assert r.score > r.base_score + 8


def test_words_that_polynomial_hashes_confuse(session):
    """Thue-Morse words of two letters are told apart."""
    one, two = "a", "b"
    for _ in range(11):
        one, two = one + two, two + one
    ids = [i for i in range(40) if not edge_rows.crc_is_two(i, 7)][:12]
    held = next(i for i in range(40, 80) if edge_rows.crc_is_two(i, 7))
    rows = [edge_rows.row(i, one) for i in ids] + [edge_rows.row(held, two)]
    df = session.createDataFrame(rows, edge_rows.SCHEMA)
    got = {r.id: r for r in suffix_tree.score(df, lambda ids: _remainder_is_two(ids, 7)).collect()}
    assert (got[held].n_tokens, got[held].n_known) == (2, 1)  # the end is known, the word is not
    assert (got[ids[0]].n_tokens, got[ids[0]].n_known) == (2, 2)


def test_columns_survive_squeezing():
    from sessionmetrics.llm.blocks import squeeze, unsqueeze

    columns = [[], [0, 0], [255, 256, 1], [2**63 + 5, 0], [1 << 40] * 3]
    back = unsqueeze(squeeze(*(np.array(c, np.uint64) for c in columns)))
    assert [c.tolist() for c in back] == columns


def test_texts_do_not_stay_beside_their_numbers(session):
    """Once words have numbers, neither texts nor the words' replies take disk."""
    docs = session.createDataFrame([(i, edge_rows.words(i, 400, 3000)) for i in range(300)], "doc_id long, text string")
    with scratch.owned() as made:
        scored = suffix_tree.score(docs, lambda ids: _remainder_is_two(ids, 7))
    paths = [p.removeprefix("file:").replace("//", "/") for p in made.paths]
    there = [p for p in paths if any(files for _, _, files in os.walk(p))]
    # numbered blocks and a table of replies for each depth
    assert len(there) == 1 + suffix_tree.DEPTH
    assert scored.count() == 300
    made.remove(session)


def _block(texts):
    from sessionmetrics.llm.blocks import Block

    data = b"".join(t + b" " for t in texts)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return Block(0, np.arange(len(texts)), offsets, np.frombuffer(data, np.uint8))


def test_every_distinct_word_is_hashed_once(monkeypatch):
    from sessionmetrics.llm import text

    block = _block([b"a B\tb a\x0ba", b"", b" \r\n", b"\xc3\x84 A c\x00", b"a"])
    words = text.Words(block.data, block.offsets)
    want = [words.hashes(0, lower).tolist() for lower in (False, True)]
    hashed = []
    hash_array = text.hash_array
    monkeypatch.setattr(text, "hash_array", lambda w, **how: hashed.append(len(w)) or hash_array(w, **how))
    tokens = suffix_tree._Tokens(block, lambda ids: ids == 1)
    assert hashed == [4]  # a, b, \xc3\x84, c\x00
    there = tokens.distinct[tokens.word]
    ends = tokens.first + tokens.size - 1
    assert (there[ends] == suffix_tree._END).all()
    assert np.delete(there, ends).tolist() == want[1]
    for lower in (False, True):
        values, at = words.distinct(0, lower)
        assert values[at].tolist() == want[lower]


@pytest.mark.parametrize("wide", [(3, 5, 2), (1 << 30, 1 << 30, 1 << 30), (1 << 62, 3, 1 << 40), (1 << 55, 7, 2)])
def test_packed_orders_are_those_of_lexsort(wide):
    from sessionmetrics.llm.text import distinct, order_by

    rng = np.random.default_rng(5)
    for n in (0, 1, 2000):
        columns = [rng.choice(rng.integers(0, w, 20), n) for w in wide]
        columns[2] = columns[2] == columns[2].max(initial=0)
        assert order_by(*columns).tolist() == np.lexsort(columns).tolist()
        values, row, which = distinct(columns[0])
        assert values.tolist() == np.unique(columns[0]).tolist()
        assert columns[0][row].tolist() == values.tolist() and values[which].tolist() == columns[0].tolist()


def test_contexts_ascend_in_each_bucket():
    """So their differences stay small, without a sort by their numbers."""
    texts = [edge_rows.words(i, 400, 60).encode() for i in range(40)]
    block, known = _block(texts), {}
    plan = suffix_tree._Plan(3, lambda ids: ids % 7 == 2, 4, 2)
    replies = {}
    for k, payload in plan.ask_words(block):
        [replies[k]] = suffix_tree._words_reply([memoryview(payload)], 2)
    plan.tokens, plan.vocabulary = 10_000, 60
    batch = plan.numbered(block, replies)
    [block] = suffix_tree.B._loaded(batch)
    for depth in (1, 2):
        names = suffix_tree._State(plan, block, known, depth - 1, ask=True).asked[0]
        order, starts = plan._contexts(names)
        assert len(names) == depth and len(order) > 20
        for a, b in zip(starts, starts[1:]):
            rows = list(zip(*(c[order[a:b]].tolist() for c in names)))
            assert rows == sorted(set(rows)) and all(min(r) > 0 for r in rows)
        for k, payload in plan.ask_pairs(block, known, depth):
            [known[depth * 3 + k]] = suffix_tree._pairs_reply([memoryview(payload)], 1.0, 4)

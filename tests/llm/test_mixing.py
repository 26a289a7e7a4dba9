"""Source mixing (10): targets, knapsack and whole-document copies."""

from __future__ import annotations

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest

import edge_rows
from sessionmetrics.llm import mixing


def _targets(sizes: dict, weights=(5.0, 2.0, 1.0), share=1.5, repeats=2):
    """Reshare by weight until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if budget * weight[s] / total >= repeats * sizes[s]}
        if not over:
            out.update({s: budget * weight[s] / total for s in open_})
            break
        for s in over:
            out[s] = float(repeats * sizes[s])
            budget -= out[s]
        open_ -= over
    return out


def test_whole_mix(edge_docs):
    rows = mixing.mix_sources(edge_docs).collect()
    docs = edge_rows.documents()
    assert len(rows) == len(docs)
    sizes: dict = defaultdict(int)
    for r in docs:
        sizes[r[3]] += len(edge_rows.as_bytes(r[1]).split())
    want = _targets(sizes)
    taken: dict = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        assert r.taken == r.copies * r.size and r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, target in want.items():
        # nothing finer than whole documents can be taken; these sizes reach all sums but few
        longest = max((r.size for r in rows if r.source == source), default=0)
        assert abs(taken[source] - target) <= max(1.0, longest / 2)
    again = mixing.mix_sources(edge_docs.repartition(5)).collect()
    key = lambda r: tuple((v is not None, v) if v is None or isinstance(v, (int, float)) else (True, v) for v in r)
    assert sorted(map(str, map(key, rows))) == sorted(map(str, map(key, again)))


@pytest.mark.parametrize("seed", range(6))
def test_targets_match_resharing(session, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 50, 1000, 7]) for i in range(rng.randrange(1, 12))}
    sizes[None] = rng.randrange(0, 90)
    df = session.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = _targets(sizes)
    assert set(got) == set(want)
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9)


def test_nearest_subset_is_the_nearest():
    rng = random.Random(3)
    for _ in range(60):
        sizes = np.array(sorted(rng.sample(range(1, 40), rng.randrange(1, 5))))
        counts = np.array([rng.randrange(0, 4) for _ in sizes])
        budget = rng.randrange(0, 90)
        take = mixing.nearest_subset(sizes, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        sums = [
            sum(a * int(s) for a, s in zip(pick, sizes))
            for pick in itertools.product(*(range(c + 1) for c in counts))
        ]
        assert abs(int((take * sizes).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_extra_copies_meet_large_budgets():
    rng = np.random.default_rng(4)
    sizes = np.unique(rng.integers(1, 20_000, 800))
    counts = rng.integers(1, 500, len(sizes))
    whole = int((sizes * counts).sum())
    for part in (0.01, 0.37, 0.5, 0.99, 1.0):
        budget = int(part * whole)
        take = mixing.extra_copies(sizes, counts, budget, whole)
        assert (take <= counts).all() and int((take * sizes).sum()) == budget


def test_word_counts(session):
    texts = ["", None, " a  b\tc\x0bd\x0ce\r\nf ", "é　x y", "one"]
    df = session.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(mixing.n_words(df["t"])).collect()]
    assert got == [len(edge_rows.as_bytes(t).split()) for t in texts]


def test_no_documents(no_docs):
    assert mixing.mix_sources(no_docs).collect() == []

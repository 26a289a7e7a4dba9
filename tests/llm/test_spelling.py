"""op11: near words, forms and roots against all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import edge_rows
from sessionmetrics.llm import spelling


def one_edit(u: str, v: str) -> bool:
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(x != y for x, y in zip(u, v)) == 1
    return len(v) - len(u) == 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def counted(rows: list[tuple], damaged: int = 31, least: int = 7, often: int = 2) -> dict[str, int]:
    total: Counter = Counter()
    for row in rows:
        doc_id, text = row[0], row[1]
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % damaged == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= often}


def expected(words: dict[str, int]) -> list[tuple]:
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def misspelt(seed: int, n: int, letters: str) -> list[str]:
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 11))) for _ in range(n)]
    out = []
    for word in base:
        out += [word] * rng.choice([2, 3, 30, 400])
        for _ in range(3):
            i = rng.randrange(len(word))
            kind = rng.randrange(3)
            out += [word[:i] + (rng.choice(letters) if kind else "") + word[i + (kind < 2) :]] * rng.randint(1, 3)
    return out


def docs_of(session, rows):
    return session.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string").repartition(3)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abÿ", min_size=7, max_size=9), unique=True, max_size=40))
def test_lists_hold_every_pair(words):
    words = sorted(words)
    found = []
    forward = spelling.WordList(words)
    for q, w in zip(*spelling.near_in_list(forward, forward)):
        found.append((words[q], words[w]))
    turned = sorted(w[::-1] for w in words)
    backward = spelling.WordList(turned)
    q, w = spelling.near_in_list(backward, backward)
    apart = ~spelling._same_ends(backward, q, w)
    found += [(turned[i][::-1], turned[j][::-1]) for i, j in zip(q[apart], w[apart])]
    assert sorted(found) == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_long_words_and_prefixes():
    words = sorted(["a" * n for n in range(60, 300, 3)] + ["b" * 5000, "b" * 5001, "c" * 90 + "x", "c" * 90 + "y"])
    found = []
    for turned in (False, True):
        listed = sorted(w[::-1] for w in words) if turned else words
        one = spelling.WordList(listed)
        q, w = spelling.near_in_list(one, one)
        found += [(listed[i][::-1], listed[j][::-1]) if turned else (listed[i], listed[j]) for i, j in zip(q, w)]
    assert set(found) == {(a, b) for a in words for b in words if one_edit(a, b)}


@pytest.mark.parametrize(("letters", "block_words"), [("abc", 16), ("abcdefghé", 64), ("xy", 8)])
def test_small_blocks(session, letters, block_words):
    """Prefixes that run over many blocks, queries that visit several."""
    words = misspelt(1, 60, letters)
    rows = [(i, " ".join(words[i::5])) for i in range(5)]
    found = spelling.variants(docs_of(session, rows), block_words=block_words)
    assert sorted(map(tuple, found.collect())) == expected(counted(rows))


def test_crowded_prefix(session):
    """A third of the words and more begin alike."""
    rng = random.Random(4)
    words = ["prefixes" + "".join(rng.choice("abcd") for _ in range(3)) for _ in range(60)]
    words += [w[:4] + w[5:] for w in words[:20]] + misspelt(5, 20, "klmnop")
    rows = [(1, " ".join(words)), (2, " ".join(words))]
    found = spelling.variants(docs_of(session, rows), block_words=8)
    assert sorted(map(tuple, found.collect())) == expected(counted(rows))


def test_forms_in_steps(session):
    words = ["letters"] * 1000 + ["lettersx"] * 100 + ["letterxx"] * 10 + ["xetterxx"] * 1
    rows = [(i, " ".join(words)) for i in range(2)]
    found = {r.word: r.root for r in spelling.variants(docs_of(session, rows), damaged=1 << 32).collect()}
    assert set(found.values()) == {"letters"}


def test_edges(session, edge_docs, no_docs):
    rows = [*edge_rows.documents(), edge_rows.row(None, "Wording wORDING ×÷ÿàèìò")]
    docs = session.createDataFrame(rows, edge_rows.SCHEMA)
    found = spelling.variants(docs)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect())) == expected(counted(rows))
    assert spelling.variants(no_docs).count() == 0

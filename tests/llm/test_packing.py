"""Packing (8): exact ids, gapless places, close to the least number."""

from __future__ import annotations

import os
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import edge_rows
from sessionmetrics.llm import packing, queries

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.vocabulary())


def _ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_pieces_are_the_tokenizers_ids(edge_docs, tokenizer):
    got = defaultdict(list)
    for r in packing.pieces(edge_docs, queries.vocabulary()).collect():
        got[r.id].append((r.piece, r.start, r.length, np.frombuffer(r.ids, "<u4").tolist()))
    for row in edge_rows.documents():
        if row[0] in (None, 40):
            continue
        want = _ids(tokenizer, row[1])
        parts = sorted(got[row[0]])
        assert [p[0] for p in parts] == list(range(len(parts)))
        assert [x for p in parts for x in p[3]] == want
        assert [p[1] for p in parts] == np.cumsum([0, *(p[2] for p in parts)])[:-1].tolist()
        assert all(p[2] == packing.SEQUENCE for p in parts[1:])
        assert len(parts) == 1 if len(want) <= packing.SEQUENCE else parts[0][2] <= packing.SEQUENCE
    assert len(got[40]) == 2 and len(got[None]) == 2  # repeated rows and null ids are packed too


@pytest.mark.parametrize("text", [
    "", " ", "\n", "a", " a", "a ", "a\n\nb", "a \n b", "  x  y  ", "it's we'll\tgo", "1 22 333.4",
    "über　straße x\u0085 y", "🙂 🙂🙂", "a<|endoftext|>b", "\r\n\r\n", "x" * 5000, "tab\t\tnew\x0b\x0cend ",
])
def test_encoder_on_odd_white_space(tokenizer, text):
    with open(queries.vocabulary(), encoding="utf-8") as file:
        encoder = packing.Encoder(file.read())
    others = ["lead in ", " trail", text, ""]
    got = dict(encoder.encode([t.encode() for t in [text, *others]]))
    for i, t in enumerate([text, *others]):
        assert got[i].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_stretches_that_polynomial_hashes_confuse(tokenizer):
    """Thue-Morse words over two letters: equal hashes modulo 2**64 in any base."""
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(1 << 11))
    texts = [word, word.translate(str.maketrans("ab", "ba")), f" {word}", word]
    with open(queries.vocabulary(), encoding="utf-8") as file:
        got = dict(packing.Encoder(file.read()).encode([t.encode() for t in texts]))
    assert [got[i].tolist() for i in range(4)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def _checked(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pack_random_lengths(session):
    rng = np.random.default_rng(1)
    sizes = np.concatenate([rng.integers(1, 90, 3000), np.full(50, 100), np.full(40, 51), np.full(200, 34)])
    df = session.createDataFrame([(int(i % 7), int(s)) for i, s in enumerate(sizes)], "id long, length long")
    rows = packing.pack(df, sequence=100, group_pieces=400).collect()
    assert sorted(r.length for r in rows) == sorted(sizes.tolist())
    used, least = _checked(rows, 100), -(-int(sizes.sum()) // 100)
    assert least <= used <= 1.03 * least  # pieces above half a sequence cannot share one


def test_crossover_keeps_every_piece_once():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 60, 200)
    free, none = np.arange(200), np.full(200, -1)
    a = packing.Solution(packing.best_fit(none, free, sizes, 100), sizes, 100)
    some = np.flatnonzero(rng.random(200) < 0.4)
    start = packing.best_fit(none, some, sizes, 100)
    b = packing.Solution(packing.best_fit(start, np.flatnonzero(start < 0), sizes, 100), sizes, 100)
    for _ in range(20):
        child = packing.crossover(a, b, sizes, 100, rng)
        assert (child.bin_of >= 0).all() and child.fill.sum() == sizes.sum() and child.fill.max() <= 100
    best = packing.evolve(sizes, 100, [a.bin_of], rng)
    assert best.rank <= a.rank


def test_no_documents(no_docs):
    assert packing.pieces(no_docs, queries.vocabulary()).collect() == []
    assert packing.pack(packing.pieces(no_docs, queries.vocabulary())).collect() == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_whole_table_is_near_the_least_number(session):
    rows = queries.op8_packing(session, DATA).collect()
    used = _checked(rows, packing.SEQUENCE)
    least = -(-sum(r.length for r in rows) // packing.SEQUENCE)
    assert used <= 1.01 * least + 1


def test_very_long_runs_of_white_space(tokenizer):
    with open(queries.vocabulary(), encoding="utf-8") as file:
        encoder = packing.Encoder(file.read())
    texts = ["a" + " " * 2_000_000 + "word", "\n" * 1_500_000, "b c"]
    got = dict(encoder.encode([t.encode() for t in texts]))
    assert [got[i].tolist() for i in range(3)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]

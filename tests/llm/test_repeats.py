"""Substring operators (6, 7) against comparing everything."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import edge_rows
from sessionmetrics.llm import difference_cover, run_length


def _got(df, *columns):
    rows = df.select("id", *columns, F.sha2("kept", 256)).collect()
    return sorted(tuple(r) for r in rows)


def test_words_match_brute_force(edge_docs):
    got = _got(difference_cover.remove_repeats(edge_docs), "n_words", "n_removed")
    assert got == edge_rows.repeated_words(edge_rows.documents())
    assert sum(r[2] for r in got) > 60_000


def test_bytes_match_brute_force(edge_docs):
    got = _got(run_length.remove_repeats(edge_docs), "n_bytes", "n_removed", "n_spans")
    assert got == edge_rows.repeated_bytes(edge_rows.documents())


def test_empty_tables(no_docs):
    assert difference_cover.remove_repeats(no_docs).collect() == []
    assert run_length.remove_repeats(no_docs).collect() == []


def _noisy(seed, alphabet, docs=60):
    """Short alphabets make repeats at all distances, in and across documents."""
    rng = random.Random(seed)
    stock = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    return [
        edge_rows.row(i * 3 % 61, " ".join(rng.choice(stock) for _ in range(rng.randrange(0, 25))))
        for i in range(docs)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_on_repetitive_text(session, seed):
    rows = _noisy(seed, "ab ")
    df = session.createDataFrame(rows, edge_rows.SCHEMA)
    for seed_bytes, block in ((7, 500), (20, 1 << 20)):
        found = run_length.remove_repeats(df, length=30, seed_bytes=seed_bytes, block_bytes=block)
        assert _got(found, "n_bytes", "n_removed", "n_spans") == edge_rows.repeated_bytes(rows, 30)


def test_crowded_anchor_is_compared_string_by_string(session):
    # one common line amid different text, with more surroundings than an index takes
    rng = random.Random(5)
    line = "".join(rng.choice("abcdefgh") for _ in range(110))
    rows = [
        edge_rows.row(i, "".join(rng.choice("klmn") for _ in range(90)) + line + "".join(rng.choice("opq") for _ in range(90)))
        for i in range(run_length.CROWDED + 200)
    ]
    df = session.createDataFrame(rows, edge_rows.SCHEMA)
    got = _got(run_length.remove_repeats(df), "n_bytes", "n_removed", "n_spans")
    assert got == edge_rows.repeated_bytes(rows)
    assert sum(r[2] for r in got) >= 110 * (len(rows) - 1)


def test_words_with_a_small_window(session):
    rows = _noisy(3, "abcd  ", 80)
    df = session.createDataFrame(rows, edge_rows.SCHEMA)
    found = difference_cover.remove_repeats(df, window=9, period=7, cover=(0, 1, 3))
    assert _got(found, "n_words", "n_removed") == edge_rows.repeated_words(rows, 9)


def test_no_difference_cover_is_refused(edge_docs):
    with pytest.raises(ValueError, match="difference cover"):
        difference_cover.remove_repeats(edge_docs, period=7, cover=(0, 1))


def test_run_index_runs_and_repeats():
    strings = [b"abcabcabcabc", b"xxabcabcabc", b"abcabcabcabc", b"q"]
    text = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.cumsum([len(s) for s in strings])
    index = run_length.RunIndex(text, ends, 8)
    marked = index.repeats(ends)
    seen, want, at = set(), [], 0
    for s in strings:
        for i in range(len(s)):
            cut = s[i : i + 8]
            want.append(len(cut) == 8 and cut in seen)
            seen.add(cut)
    assert marked.tolist() == want
    assert len(index.start) < len(text)  # runs are fewer than rows


def test_indexes_of_some_anchors_at_a_time(monkeypatch):
    from sessionmetrics.llm import blocks

    rng = random.Random(7)
    rows = []
    for key in range(40):
        # as strings of different anchors do, those of different keys differ
        stem = bytes(rng.choice(b"abc") for _ in range(6)) + bytes([100 + key]) + bytes(rng.choice(b"abc") for _ in range(5))
        for _ in range(rng.randrange(1, 6)):
            rows.append((key, rng.randrange(50), rng.randrange(100), stem + bytes(rng.choice(b"ab") for _ in range(5))))
    rng.shuffle(rows)
    payloads = []
    for part in (rows[:60], rows[60:]):
        key, doc, pos, text = zip(*part)
        columns = (np.array(key, "u8"), np.array(doc, "i8"), np.array(pos, "u4"), np.array(list(map(len, text))))
        payloads.append(memoryview(blocks.pack(*columns) + b"".join(text)))
    whole = run_length._edges_reply(payloads, 14)
    monkeypatch.setattr(run_length, "INDEX_BYTES", 64)
    assert run_length._edges_reply(payloads, 14) == whole
    assert any(len(r) > 8 for r in whole)


def _thue_morse(order):
    """Two different texts that collide under every polynomial hash modulo 2**64."""
    one, two = "a", "b"
    for _ in range(order):
        one, two = one + two, two + one
    return one, two


def test_words_that_polynomial_hashes_confuse(session):
    one, two = _thue_morse(11)
    tail = " ".join(f"w{i}" for i in range(60))
    rows = [edge_rows.row(1, f"{one} {tail}"), edge_rows.row(2, f"{two} {tail}"), edge_rows.row(3, f"{two} {tail}")]
    df = session.createDataFrame(rows, edge_rows.SCHEMA)
    want = edge_rows.repeated_words(rows)
    assert [r[2] for r in want] == [0, 60, 61]
    assert _got(difference_cover.remove_repeats(df), "n_words", "n_removed") == want


def test_bytes_that_polynomial_hashes_confuse(session):
    one, two = _thue_morse(11)
    rows = [edge_rows.row(1, one), edge_rows.row(2, two), edge_rows.row(3, "x" + two)]
    df = session.createDataFrame(rows, edge_rows.SCHEMA)
    found = run_length.remove_repeats(df)
    assert _got(found, "n_bytes", "n_removed", "n_spans") == edge_rows.repeated_bytes(rows)

"""The corpus pipeline, stage by stage, against plain versions."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline as pipeline
import edge_rows
from sessionmetrics.llm import scratch
from test_near_duplicates import _expected


@pytest.fixture(scope="module")
def stages(session, edge_docs):
    """Input and written output of every stage."""
    docs, out = edge_docs, {}
    for name, stage in pipeline.STAGES:
        done = scratch.written(stage(session, docs, ""), f"test-{name}")
        out[name] = (docs, done)
        docs = done
    return out


def _rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_columns_pass_through(stages, edge_docs):
    for name, _ in pipeline.STAGES[:-1]:
        assert stages[name][1].columns == edge_docs.columns
        assert dict(stages[name][1].dtypes) == dict(edge_docs.dtypes)
        assert stages[name][1].where("kept <> 'x' or bucket <> 7").count() == 0


def test_language_rejects_texts_without_letters(stages):
    before, after = map(_rows, stages["language"])
    gone = Counter(r[0] for r in before) - Counter(r[0] for r in after)
    assert gone == Counter([1, 2, 4, 5, None])  # the null id with a null text


def _in_order(rows):
    """(place, row) by id, rows without one last."""
    return list(enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, _hash(r[1])))))


def _hash(text):
    return _HASHES.setdefault(text, len(_HASHES))


_HASHES: dict = {}


def test_one_of_each_group_stays(stages):
    before, after = map(_rows, stages["near_duplicates"])
    placed = _in_order(before)
    want = {place for place, _, first in _expected([(i, *r[1:]) for i, r in placed]) if place == first}
    # of rows that share an id and a group any may stay
    assert Counter(r[0] for r in after) == Counter(r[0] for i, r in placed if i in want)
    assert not Counter(after) - Counter(before)


def test_passages_are_cut(stages):
    before, after = map(_rows, stages["repeated_passages"])
    removed = edge_rows.repeated_words([(i, *r[1:]) for i, r in _in_order(before)])
    row = dict(_in_order(before))
    want = Counter((row[i][0], n - cut) for i, n, cut, _ in removed if cut < n)
    assert Counter((r[0], len(r[1].encode().split())) for r in after) == want
    assert all(r[4] == len(r[1]) for r in after)


def test_mixture_repeats_documents(stages):
    before, after = map(_rows, stages["mixture"])
    count = Counter(r[0] for r in after)
    assert set(count.values()) <= {1, 2} and set(after) <= set(before)
    sizes = [len(r[1].encode().split()) for r in before]
    mixed = sum(len(r[1].encode().split()) for r in after)
    # one document holds most words, and only whole documents are taken
    assert abs(mixed - 1.5 * sum(sizes)) <= max(sizes) / 2 + 100


def test_sequences_hold_all_documents(stages):
    before, after = stages["sequences"]
    docs, rows = Counter(r.doc_id for r in before.collect()), after.collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == docs
    fill: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 2048


def test_empty_table_through_all_stages(session, no_docs):
    docs = no_docs
    for name, stage in pipeline.STAGES:
        docs = scratch.written(stage(session, docs, ""), f"empty-{name}")
        assert docs.count() == 0


def test_without_languages_only_texts_without_letters_go(session):
    rows = [edge_rows.row(1, "hello", lang=None), edge_rows.row(2, "12 !", lang=None)]
    df = session.createDataFrame(rows, edge_rows.SCHEMA)
    assert [r.doc_id for r in pipeline.STAGES[0][1](session, df, "").collect()] == [1]


def _through(session, stage, rows, columns="doc_id, text"):
    docs = session.createDataFrame([edge_rows.row(*r) for r in rows], edge_rows.SCHEMA)
    out = dict(pipeline.STAGES)[stage](session, docs, "")
    return sorted((tuple(r) for r in out.selectExpr(*columns.split(", ")).collect()), key=str)


def test_rows_that_share_an_id_or_have_none(session):
    """A document is a row: copies go, unlike ones stay, whatever their ids."""
    a, b, c, d = (edge_rows.words(700 + i, 90, 3000) for i in range(4))
    assert _through(session, "near_duplicates", [(1, b), (5, a), (5, b)]) == [(1, b), (5, a)]
    assert len(_through(session, "near_duplicates", [(10, a), (10, b)])) == 2
    got = _through(session, "near_duplicates", [(None, a), (None, b), (None, b), (7, c), (None, c)])
    assert got == sorted([(7, c), (None, a), (None, b)], key=str)
    w = edge_rows.words(800, 60, 3000)
    got = _through(session, "repeated_passages", [(1, w), (5, f"{w} tail five"), (5, "short other text"), (None, f"{d} {w}")])
    assert got == sorted([(1, w), (5, "tail five"), (5, "short other text"), (None, d)], key=str)
    mixed = _through(session, "mixture", [(3, a), (3, b), (None, c), (None, d), (4, "x")])
    # one source: one and a half times its words, no row more than twice
    assert set(mixed) >= {(3, a), (3, b), (None, c), (None, d), (4, "x")} and max(Counter(mixed).values()) == 2
    assert sum(len(t.split()) for _, t in mixed) == pytest.approx(1.5 * 361, abs=46)


def test_run_leaves_only_its_result(session):
    import os

    from sessionmetrics.session import shared_dir

    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("no test data")
    root = shared_dir(session).removeprefix("file:")
    before, tables = set(os.listdir(root)), {t.name for t in session.catalog.listTables()}
    rows = pipeline.run(session, data)
    left = set(os.listdir(root)) - before
    assert [n.rsplit("-", 1)[0] for n in left] == ["stage-sequences"]
    assert {t.name for t in session.catalog.listTables()} == tables
    assert rows.count() > 0

"""Language identification (9): held-out accuracy and edges."""

from __future__ import annotations

import math
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import edge_rows
from sessionmetrics.llm import language, queries

DATA = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_held_out_accuracy(session):
    found = queries.op9_language(session, DATA)
    truth = queries.table(session, DATA, "documents").select("doc_id", "lang")
    got = found.join(truth, "doc_id").where("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")
    ).first()
    assert got[1] > 100 and got[0] >= 0.98


def _slot(gram: str) -> int:
    """The slot of one n-gram, character by character."""
    hashed = 0
    for c in gram:
        hashed = (hashed * 0x100000001B3 + ord(c) + 1) % 2**64
    mixed = language.mix(np.array([(hashed + len(gram) - 1) % 2**64], np.uint64))
    return int(mixed[0]) // 2**32 % language.SLOTS


def _grams(text: str) -> Counter:
    padded = "  " + text.lower() + "  "
    return Counter(_slot(padded[i : i + k]) for i in range(len(text) + 2) for k in (1, 2, 3))


def test_naive_bayes_in_plain_python(session):
    taught = [
        ("the cat sat on the mat", "en"), ("The dog and the cat", "en"), ("le chat est sur la table", "fr"),
        ("la table et le chien", "fr"), ("el gato y el perro", "es"), ("no letters taught: 123", None), (None, "es"),
        ("12 34", "de"), ("the cat sat on the mat", "en"),
    ]
    asked = ["the table", "le gato", "dog", "perro y perro", "x", "La Table 99", "the cat sat on the mat"]
    model = language.fit(session.createDataFrame(taught, "text string, lang string").repartition(3))
    found = language.identify(session.createDataFrame([(t,) for t in asked], "text string"), model, keep=("text",))
    counts: dict = {}
    n_docs: Counter = Counter()
    for text, lang in taught:
        if text is not None and lang is not None and any(c.isalpha() for c in text):
            counts.setdefault(lang, Counter()).update(_grams(text))
            n_docs[lang] += 1
    assert model.languages == sorted(counts) == ["en", "es", "fr"]
    for row in found.collect():
        logs = {}
        for lang, seen in counts.items():
            total = sum(seen.values()) + 0.5 * language.SLOTS
            logs[lang] = math.log(n_docs[lang] / sum(n_docs.values())) + sum(
                n * math.log((seen[g] + 0.5) / total) for g, n in _grams(row.text).items()
            )
        best = max(sorted(logs), key=logs.get)
        assert row.lang_pred == best
        assert abs(row.score - 1 / sum(math.exp(v - logs[best]) for v in logs.values())) < 1e-9


def test_edges(edge_docs):
    model = language.fit(edge_docs)
    got = {
        r.doc_id: r for r in language.identify(edge_docs, model, keep=("doc_id", "kept")).collect()
    }
    for doc in (1, 2, 4, 5):  # null, empty, blank, no letter
        assert (got[doc].lang_pred, got[doc].score) == ("und", 0.0)
    assert got[8].lang_pred == "fr" and 0 < got[8].score <= 1
    assert got[30].lang_pred == "en"  # 60,000 words, read whole
    assert got[3].kept == "x"  # other columns pass


def test_long_texts_are_read_to_the_end(session):
    model = language.Model(["a", "b"], language.np.zeros((2, 1 << 14)), language.np.log([0.5, 0.5]))
    grams, _ = language._slots(["zz"], 1 << 14)
    model.matrix[1, grams[1][language.LONGEST - 1]] = 5.0  # the pair of letters
    names, _ = model.predict([". " * (2 * language._PIECE) + "zz", "zz", "q"])
    assert names == ["b", "b", "a"]


def test_nothing_to_learn(session, no_docs):
    model = language.fit(no_docs)
    assert model.languages == []
    df = session.createDataFrame([edge_rows.row(1, "hello")], edge_rows.SCHEMA)
    assert language.identify(df, model).first().lang_pred == "und"
    assert language.identify(no_docs, model).collect() == []


def test_too_many_languages_are_refused(session, monkeypatch):
    monkeypatch.setattr(language, "MATRIX_BYTES", 1000)
    df = session.createDataFrame([edge_rows.row(1, "hello")], edge_rows.SCHEMA)
    with pytest.raises(ValueError, match="bound"):
        language.fit(df)

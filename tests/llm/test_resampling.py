"""Importance resampling (3) and the k-th largest key."""

from __future__ import annotations

import math
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import edge_rows
from sessionmetrics.llm import queries, resampling

DATA = "/root/testdata/sf0.01"


def test_kth_largest(session):
    rng = random.Random(1)
    values = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(200)] + [5] * 40 + [-1, 0, (1 << 63) - 1, -(1 << 63)]
    df = session.createDataFrame([(v,) for v in values], "v long").repartition(3)
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 100, 150, len(values)):
        assert resampling.kth_largest(df, "v", k) == ordered[k - 1]
    assert resampling.kth_largest(df, "v", len(values) + 1) is None


def _grams(text):
    w = edge_rows.as_bytes(text).lower().split()
    return w + list(zip(w, w[1:]))


def test_weights_match_brute_force_with_enough_slots(edge_docs, session):
    """With far more slots than n-grams hashing changes nothing."""
    rows = [r for r in edge_rows.documents() if r[0] not in (30, 31)]
    df = session.createDataFrame(rows, edge_rows.SCHEMA)
    slots = 1 << 22
    target = {10, 3, 25}
    ids = session.createDataFrame([(i,) for i in target] + [(None,)], "doc_id long")
    got = {r.id: r for r in resampling.resample(df, ids, 0.5, slots=slots).collect() if r.id is not None}
    raw, wanted = Counter(), Counter()
    for r in rows:
        raw.update(_grams(r[1]))
        if r[0] in target:
            wanted.update(_grams(r[1]))
    total, mine = sum(raw.values()) + slots, sum(wanted.values())
    for r in rows:
        if r[0] is None:
            continue
        want = 0.0
        for g in _grams(r[1]):
            p = (raw[g] + 1) / total
            want += math.log((wanted[g] + slots * p) / (mine + slots)) - math.log(p)
        assert got[r[0]].log_weight == pytest.approx(want, abs=1e-6)
        assert got[r[0]].n_grams == len(_grams(r[1]))


def test_largest_draws_are_kept(edge_docs):
    ids = edge_docs.where("doc_id >= 100").select("doc_id")
    rows = resampling.resample(edge_docs, ids, 0.4).collect()
    k = math.ceil(0.4 * len(rows))
    kept = [r.draw for r in rows if r.kept]
    assert len(kept) >= k and len(kept) <= k + 2  # rows with one id go together
    assert min(kept) >= max([r.draw for r in rows if not r.kept], default=-math.inf)
    again = resampling.resample(edge_docs, ids, 0.4).collect()
    key = lambda r: (r.id is not None, r.id or 0, r.draw, r.kept)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_noise_is_gumbel(session):
    x = np.array([r[0] for r in session.range(20_000).select(resampling.noise(F.col("id"), 1)).collect()])
    assert abs(x.mean() - 0.5772) < 0.03 and abs(x.var() - math.pi**2 / 6) < 0.06


def test_no_targets_and_no_documents(edge_docs, no_docs):
    none = no_docs.select("doc_id")
    rows = resampling.resample(edge_docs, none, 1.0).collect()
    assert all(r.log_weight == 0 and r.kept for r in rows)
    assert resampling.resample(no_docs, none, 0.5).collect() == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_good_documents_stay_and_poor_ones_go(session):
    found = queries.op3_quality_resampling(session, DATA)
    labels = queries.table(session, DATA, "labels")
    got = {
        r[0]: r[1]
        for r in found.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    }
    assert got[1] > 0.95 and got[0] < 0.4


@pytest.mark.parametrize("poor", [0, 160])
def test_quota_follows_the_corpus(session, tmp_path, poor):
    """400 documents: as many stay as are like the targets, be it all or 60 %."""
    docs = [(i, edge_rows.words(i, 60) if i >= poor else edge_rows.words(i, 60).replace("w", "z")) for i in range(400)]
    labels = [(i, int(i >= poor), 0) for i in range(400)]
    session.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    session.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = {r.doc_id for r in queries.op3_quality_resampling(session, str(tmp_path)).where("kept").collect()}
    assert sum(i >= poor for i in kept) >= 0.98 * (400 - poor)
    assert sum(i < poor for i in kept) <= 0.05 * poor

"""op13: ids against the tokenizers library, files read back."""

from __future__ import annotations

import json
import os
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import edge_rows
from sessionmetrics.llm import token_files, token_ids
from sessionmetrics.llm.queries import vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


def whole(tokenizer, text) -> list[int]:
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def odd_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    parts = ["word", "Word's", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", " ", " ", "12", "!?", "éß", "中文",
             "\U0001f600", "<|endoftext|>", "\x00", "á", "'ll", "�"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_stretches_give_the_ids_of_whole_texts(tokenizer, monkeypatch):
    encoder = token_ids.Encoder(tokenizer.to_str())
    # two texts that polynomial hashes modulo 2**64 cannot tell apart
    thue = "".join("ab"[bin(i).count("1") & 1] for i in range(1 << 11))
    texts = odd_texts(1, 300) + [thue, thue.translate(str.maketrans("ab", "ba")), "x" * 3000, ""]
    for kept in (token_ids._KEPT, 5):
        monkeypatch.setattr(token_ids, "_KEPT", kept)
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode([t.encode() for t in texts])]
        assert got == [whole(tokenizer, t) for t in texts]


def expected(tokenizer, rows) -> list[tuple]:
    """(doc_id, n_tokens, crc32) in order of doc_id, nulls first."""
    out = []
    for doc_id, text in ((r[0], r[1]) for r in rows):
        ids = np.array([*whole(tokenizer, text), 2], "<u4")
        out.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def check(found, want):
    rows = sorted(found.collect(), key=lambda r: r.start)
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])])[:-1].tolist()
    got = [(r.doc_id, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in rows]
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_round_trip(session, tokenizer, scratch):
    rows = [(i * 3 % 101, t) for i, t in enumerate(odd_texts(2, 101))]
    rows += [(None, "no id"), (None, None), (7, "again"), (7, "again"), (1000, edge_rows.words(1, 5000))]
    docs = session.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = os.path.join(scratch, "tokens")
    found = token_files.write(docs, path, vocabulary(), part_bytes=4000)
    check(found, expected(tokenizer, rows))
    manifest = json.load(open(os.path.join(path, "manifest.json")))
    assert len(manifest["parts"]) > 1 and manifest["documents"] == len(rows)
    # some documents alone
    some = token_files.lookup(session, path, [3, 7, 1000, 5000])
    assert sorted(r.doc_id for r in some.collect()) == sorted(r[0] for r in rows if r[0] in (3, 7, 1000))
    assert token_files.lookup(session, path, [5000]).count() == 0
    # written again, the files of before are gone
    check(token_files.write(docs.limit(3), path, vocabulary()), expected(tokenizer, docs.limit(3).collect()))
    stems = {f.split(".")[0] for f in os.listdir(path) if f.endswith((".tokens", ".index"))}
    assert stems == {p["name"] for p in json.load(open(os.path.join(path, "manifest.json")))["parts"]}


def test_lost_attempts_and_damage(session, tokenizer, scratch):
    rows = [(i, edge_rows.words(i, 40)) for i in range(50)]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    path = os.path.join(scratch, "damaged")
    found = token_files.write(docs, path, vocabulary())
    # what a lost executor leaves behind is in no manifest
    open(os.path.join(path, "000000-lost.tokens"), "wb").write(b"half a frame")
    check(token_files.read(session, path), expected(tokenizer, rows))
    name = json.load(open(os.path.join(path, "manifest.json")))["parts"][0]["name"]
    data = bytearray(open(os.path.join(path, f"{name}.tokens"), "rb").read())
    data[len(data) // 2] ^= 255
    open(os.path.join(path, f"{name}.tokens"), "wb").write(data)
    with pytest.raises(Exception, match="(?i)zstd|checksum|corrupt|does not match"):
        found.collect()
    open(os.path.join(path, "dictionary"), "wb").write(b"another")
    with pytest.raises(Exception, match="dictionary is not the one"):
        token_files.read(session, path).collect()
    with pytest.raises(Exception, match="no finished token files"):
        token_files.read(session, os.path.join(scratch, "nothing")).collect()


def test_dictionary_is_shared_and_helps(session, scratch):
    """Short documents of one kind take less room than alone."""
    import zstandard

    rows = [(i, edge_rows.words(i, 60, 300)) for i in range(1500)]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    path = os.path.join(scratch, "dictionary")
    found = token_files.write(docs, path, vocabulary())
    manifest = json.load(open(os.path.join(path, "manifest.json")))
    assert os.path.getsize(os.path.join(path, "dictionary")) > 1000
    alone = sum(
        len(zstandard.compress(np.frombuffer(bytes(r.ids), "<u4").astype("<u2").tobytes(), token_files.LEVEL))
        for r in found.collect()
    )
    assert sum(p["bytes"] for p in manifest["parts"]) < 0.8 * alone


def test_edges(session, tokenizer, edge_docs, no_docs, scratch):
    found = token_files.write(edge_docs, os.path.join(scratch, "edges"), vocabulary())
    check(found, expected(tokenizer, edge_rows.documents()))
    empty = token_files.write(no_docs, os.path.join(scratch, "empty"), vocabulary())
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "n_tokens", "ids"]


def test_encoding_takes_little_more_room_than_the_text(tokenizer):
    import tracemalloc

    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(1 << 16)}" for _ in range(1_200_000)).encode()
    encoder = token_ids.Encoder(tokenizer.to_str())
    tracemalloc.start()
    try:
        [found] = encoder.encode([text])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 10 * len(text)
    assert np.frombuffer(found, "<u4").tolist() == whole(tokenizer, text.decode())


def test_texts_that_are_no_utf8(tokenizer):
    texts = [b"\xff\xfe a\xc3 b\xff", b"\xc3", b"plain", b"\xed\xb3\xbf x", b"\xe4\xb8"]
    got = [np.frombuffer(b, "<u4").tolist() for b in token_ids.Encoder(tokenizer.to_str()).encode(texts)]
    assert got == [whole(tokenizer, t.decode("utf-8", "replace")) for t in texts]


@pytest.mark.parametrize("equal", [False, True])
def test_training_rows_are_those_of_least_hash(session, equal):
    from pyspark.sql import functions as F

    n = 3 * 4 * token_files.TRAINING_DOCUMENTS
    key = F.lit(1) if equal else F.col("id")
    rows = session.range(0, n, 1, 7).select(key.alias("doc_id"), F.concat(F.lit("text "), key).alias("text"))
    found = [r.text for r in token_files._least(rows, n).collect()]
    hashed = rows.select("text", F.xxhash64("doc_id", "text").alias("h"), "doc_id").collect()
    least = sorted(hashed, key=lambda r: (r.h, r.doc_id))[: token_files.TRAINING_DOCUMENTS]
    assert sorted(found) == sorted(r.text for r in least)


def test_words_are_encoded_once_whatever_follows_them(tokenizer, monkeypatch):
    """A word before a comma, full stop or nothing is one stretch, and takes no split."""
    encoder = token_ids.Encoder(tokenizer.to_str())
    encoded, split = [], []
    inner, findall = encoder.stretches._encoded, encoder.stretches.split
    monkeypatch.setattr(encoder.stretches, "_encoded", lambda words: encoded.extend(words.to_pylist()) or inner(words))
    monkeypatch.setattr(encoder.stretches, "split", lambda text: split.append(text) or findall(text))
    texts = ["a thonre, été. thonre été; thonre?", "a: thonre's 12.5 a"]
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode([t.encode() for t in texts])]
    assert got == [whole(tokenizer, t) for t in texts]
    assert sorted(w.decode() for w in encoded) == sorted(
        ["a", " thonre", ",", " été", ".", ";", "?", ":", "'s", " 12", ".5", " a"]
    )
    assert not any("thonre" in text or "été" in text for text in split)


@pytest.mark.parametrize("seed", [5, 6])
def test_cuts_at_punctuation_give_the_ids_of_whole_texts(tokenizer, seed):
    rng = random.Random(seed)
    parts = [*"aZ9 .,'\"-_~!\n\t\x00\x1c\x7f", "é", "×", "÷", "À", "ÿ", "Ā", "́", "²", "½", "…", "’", "–", "'re", "'S", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    encoder = token_ids.Encoder(tokenizer.to_str())
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode([t.encode() for t in texts])]
    assert got == [whole(tokenizer, t) for t in texts]

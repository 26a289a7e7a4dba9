"""Documents and vectors with every awkward case, and brute-force versions."""

from __future__ import annotations

import hashlib
import random
import zlib

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use themselves
    "id string, block string, bucket int, fp string, component long, size string, length string, item int, "
    "kept string, score string, lang_pred string, copies string, grp string, _row string, _text string, ids string"
)
_CLASHING = ("x",) * 2 + (7, "x", 9, "x", "x", 3) + ("x",) * 8


def row(doc_id, text, lang="en", source="s0"):
    return (doc_id, text, lang, source, None if text is None else len(text), *_CLASHING)


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents() -> list[tuple]:
    """Copies, shared passages, nulls, empty and very long texts, odd white
    space, repeated rows, many sources and languages."""
    passage, other = words(1, 80), words(2, 60)
    long = words(3, 60_000, 50_000)
    out = [
        row(10, f"{words(4, 30)} {passage} {words(5, 30)}"),
        row(3, f"{words(6, 10)} {passage} {other} {words(7, 12)}"),
        row(25, f"{passage}\n{passage}", source=None),
        row(26, passage),
        row(27, passage),
        row(28, f"{other}\t\x0b {other}  {words(8, 5)}", source="s1"),
        row(1, None),
        row(2, "", lang=None),
        row(4, " \t\r\n ", source="s2"),
        row(5, "!!! 123 ...", source="s2"),
        row(6, "one two"),
        row(7, "One TWO"),
        row(8, "é　ü ß x été", lang="fr", source="s1"),
        row(9, "a<|endoftext|>b  c", source="s1"),
        row(30, long, source="s3"),
        row(31, long + " tail", source="s3"),
        row(32, "a" * 5000, source="s3"),
        row(33, "ab" * 300, source="s3"),
        row(None, passage),
        row(None, None, lang=None, source=None),
        row(40, f"{words(9, 40)} {passage}"),
        row(40, f"{words(9, 40)} {passage}"),  # a repeated row
    ]
    out += [row(100 + i, words(50 + i, 20 + i % 7), source=f"s{i % 4}") for i in range(30)]
    return out


def crc_is_two(doc_id: int, modulus: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % modulus == 2


def as_bytes(text) -> bytes:
    return (text or "").encode()


def repeated_words(rows: list[tuple], window: int = 50) -> list[tuple]:
    """(doc_id, n_words, n_removed, sha256) by comparing all windows."""
    docs = sorted((r[0], as_bytes(r[1]).split()) for r in rows if r[0] is not None)
    first: dict = {}
    for doc, w in docs:
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), doc)
    out = []
    for doc, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def repeated_bytes(rows: list[tuple], length: int = 100) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, sha256) by comparing all strings."""
    docs = sorted((r[0], as_bytes(r[1])) for r in rows if r[0] is not None)
    first: dict = {}
    for doc, b in docs:
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            first[s] = min(first.get(s, (doc, i)), (doc, i))
    out = []
    for doc, b in docs:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (doc, i):
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def components(n: int, links) -> list[int]:
    """Smallest node reachable from each of 0..n-1."""
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]

"""Words and rolling hashes of whole texts, a block of documents at a time.

A block holds the UTF-8 bytes of many documents in one array, every document
followed by one space, so that one numpy pass finds the words of all of them
and no word crosses a document.  Words are runs of bytes outside
``[\\x20\\x09-\\x0D]``.

Words are told apart by SipHash.  Hashes of other stretches are polynomials
modulo 2**64 over randomised symbols: the hash of a stretch comes from two
prefix sums, whatever its length.  Two independent families (``salt`` 0 and 1)
give 128 bits where equality decides a result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pandas.util import hash_array

SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_WORD_KEYS = ("words of a block", "the second key..")
_BASES = (0x9E3779B97F4A7C15 | 3, 0xC2B2AE3D27D4EB4F | 3)
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser that spreads every bit of a 64-bit hash."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=4)
def byte_symbols(salt: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(_BASES[salt]) + U(salt + 1))


#: Powers that a worker keeps; longer texts compute theirs anew.
_KEPT_POWERS = (2 << 20) + (1 << 16)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def powers(salt: int, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, or the inverses' powers."""
    have = _POWERS.get((salt, inverse))
    if have is None or len(have) < n:
        base = pow(_BASES[salt], -1, 1 << 64) if inverse else _BASES[salt]
        have = np.full(max(n, 1 << 16), base, dtype=U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= _KEPT_POWERS:
            _POWERS[(salt, inverse)] = have
    return have[:n]


class Rolling:
    """Hashes of stretches of a sequence of 64-bit symbols."""

    def __init__(self, symbols: np.ndarray, salt: int):
        self.salt = salt
        n = len(symbols)
        self.prefix = np.zeros(n + 1, dtype=U)
        np.cumsum(symbols * powers(salt, n), out=self.prefix[1:])
        self.inverse = powers(salt, n + 1, inverse=True)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hash of symbols[start:end] for arrays of bounds."""
        raw = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
        return mix(raw + (end - start).astype(U) * U(0x9E3779B97F4A7C15))

    def windows(self, length: int) -> np.ndarray:
        """Mixed hash of every stretch of ``length`` symbols."""
        n = len(self.prefix) - length
        if n <= 0:
            return np.zeros(0, dtype=U)
        raw = (self.prefix[length:] - self.prefix[:n]) * self.inverse[:n]
        return mix(raw + np.full(1, length, U) * U(0x9E3779B97F4A7C15))


class Words:
    """The words of a block: byte bounds, and the word range of each document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        separator = (data == 0x20) | (data - np.uint8(0x09) < 5)  # SEPARATORS
        before = np.empty(len(data), dtype=bool)
        if len(data):
            before[0] = True
            before[1:] = separator[:-1]
        self.data = data
        self.start = np.flatnonzero(~separator & before)
        self.end = np.flatnonzero(separator & ~before)  # each document ends in a space
        self.doc = np.searchsorted(self.start, offsets)  # word range of document i: doc[i]..doc[i+1]

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, salt: int, lower: bool = False) -> np.ndarray:
        """SipHash of every word, with a key for each salt."""
        data = self.data.tobytes()
        words = np.empty(len(self), dtype=object)
        words[:] = (data.lower() if lower else data).split()  # bytes split at SEPARATORS
        return hash_array(words, hash_key=_WORD_KEYS[salt], categorize=False)

    def distinct(self, salt: int, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The same with every distinct word hashed once: hashes, and the place
        among them of every word."""
        letters = self.data.tobytes().translate(LOWER.tobytes() if lower else None, bytes(SEPARATORS))
        offsets = np.concatenate([[0], np.cumsum(self.end - self.start)]).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
        every = pa.Array.from_buffers(pa.large_binary(), len(self), buffers).dictionary_encode()
        words = every.dictionary.to_numpy(zero_copy_only=False)
        return hash_array(words, hash_key=_WORD_KEYS[salt], categorize=False), every.indices.to_numpy()

    def owner(self) -> np.ndarray:
        """The document index of every word."""
        return np.repeat(np.arange(len(self.doc) - 1), np.diff(self.doc))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of arange(s, s + c)."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - first, counts)


def order_by(*columns: np.ndarray) -> np.ndarray:
    """``np.lexsort`` of columns of whole numbers from 0 up: with the place in
    the order so far, as many columns as fit are one 64-bit number to sort."""
    n = len(columns[0])
    low = n.bit_length()
    order, key, used = None, np.arange(n), low

    def ordered() -> np.ndarray:
        place = np.sort(key) & ((1 << low) - 1)
        return place if order is None else order[place]

    for column in columns:
        width = int(column.max(initial=0)).bit_length()
        if used + width > 63:
            if low + width > 63:
                return np.lexsort(columns)
            order, key, used = ordered(), np.arange(n), low
        column = column.astype(np.int64)
        key |= (column if order is None else column[order]) << used
        used += width
    return ordered()


def distinct(column: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of a column of whole numbers from 0 up, ascending; a
    row of each; and the place among them of every row."""
    order = order_by(column)
    there = column[order]
    new = np.ones(len(column), bool)
    new[1:] = there[1:] != there[:-1]
    which = np.empty(len(column), np.int64)
    which[order] = np.cumsum(new) - 1
    return there[new], order[new], which

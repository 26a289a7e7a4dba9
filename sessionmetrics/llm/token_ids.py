"""Token ids of whole texts, put together from stretches encoded once.

A stretch is a run of ASCII white space with the word after it, as far as that
word's first ASCII punctuation mark after a letter or digit; there the next
one begins.  Byte-level BPE splits a text before any white space and between a
letter or digit and such a mark, and inside a stretch by nothing
outside it, so the ids of a text are those of its stretches, one after the
other.  A worker keeps the ids of the stretches it has met (compared byte by
byte, as keys of a dictionary); new ones are split as the vocabulary's own
splitter does (one space and letters are one piece) and handed to the BPE model
of the ``tokenizers`` library, many pieces in one call: between them stands a
byte that no merge holds, so none reaches across.  A text with a special token, or with white space outside
ASCII (whose runs a cut could divide), is encoded by the library in one go,
and so is every text if the vocabulary is of another kind.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .text import ranges

# UTF-8 of the white space that is not ASCII.
WIDE_SPACE = [
    chr(c).encode()
    for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
]
# How those of them begin that differ in the last byte alone, each once.
_WIDE_STARTS = sorted({x if x[0] != 0xE2 else x[:2] for x in WIDE_SPACE})
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LETTER = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])
_DIGIT = np.array([0x30 <= b <= 0x39 for b in range(256)])
_PUNCTUATION = np.array([0x21 <= b <= 0x7E for b in range(256)]) & ~_LETTER & ~_DIGIT
# Fixed value: the split of byte-level BPE.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
# A long text is taken in parts that end before white space that follows a word.
_CUT = re.compile(rb"(?<=[^\x20\x09-\x0D])[\x20\x09-\x0D]")
_ID = attrgetter("id")
#: Stretches a worker keeps, none longer than so many bytes.
_KEPT = 400_000
_KEPT_BYTES = 64
#: Bytes of text looked up together, and pieces the BPE model gets in one call.
_TOGETHER = 2 << 20
_PIECES = 32


def _letters() -> str:
    """Byte-level vocabularies write each byte as one printable letter: itself
    if it is printable in Latin-1, else the next letter from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


def _mark(model: dict) -> int | None:
    """A byte that no UTF-8 text and no merge of the vocabulary holds."""
    merged = {c for merge in model["merges"] for c in "".join(merge)}
    letters = _letters()
    free = [b for b in (0xFF, 0xFE, *range(0xF5, 0xFE), 0xC0, 0xC1) if letters[b] not in merged]
    return next((b for b in free if letters[b] in model["vocab"]), None)


def _ends_letter(raw: np.ndarray) -> np.ndarray:
    """Bytes of UTF-8 that end a letter, of ASCII or U+00C0 to U+00FF."""
    found = _LETTER[raw]
    found[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)  # not the signs of times and division
    return found


def _lengths(words: pa.BinaryArray) -> np.ndarray:
    return pc.binary_length(words).to_numpy().astype(np.int64)


class _Stretches:
    """The ids of stretches, those met lately kept: the words, and the stretch
    of ``flat`` that each one's ids are."""

    def __init__(self, tokenizer, split, mark: int):
        self.tokenize, self.split, self.letters = tokenizer.model.tokenize, split, _letters()
        # in a str, a byte that is no UTF-8 has a character of its own
        self.mark, self.between, self.mark_id = mark, chr(0xDC00 + mark), tokenizer.token_to_id(self.letters[mark])
        self.words = pa.array([], pa.binary())
        self.begin, self.many, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _encoded(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of new stretches: begin and number of each one's, and all ids."""
        n = len(words)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        ends = np.cumsum(_lengths(words))
        data = b"".join(words.buffers()[2:])[: ends[-1]]
        raw = np.frombuffer(data, np.uint8)
        begin = np.append(0, ends[:-1])
        # a space, or none, and letters are one piece
        other = ~_ends_letter(raw) & (raw != 0xC3)
        other[begin] &= raw[begin] != 0x20
        simple = np.add.reduceat(other, begin, dtype=np.int64) == 0
        # those from white space to the end of a word are split together
        plain = _SPACE[raw[begin]] & ~_SPACE[raw[ends - 1]] & ~simple
        rest = ~plain & ~simple
        order = np.concatenate([np.flatnonzero(some) for some in (simple, plain, rest)])
        together = words.filter(pa.array(plain)).to_numpy(zero_copy_only=False)
        pieces = self.split(b"".join(together).decode())
        for word in words.filter(pa.array(rest)).to_pylist():
            pieces += self.split(word.decode())
        one_each = words.filter(pa.array(simple)).to_numpy(zero_copy_only=False)
        joined = bytes([self.mark]).join([*one_each, b""])
        joined += self.between.join([*pieces, ""]).encode("utf-8", "surrogateescape")
        marks = np.flatnonzero(np.frombuffer(joined, np.uint8) == self.mark)
        ends = np.cumsum(_lengths(words)[order])
        ends_of_pieces = marks - np.arange(len(marks))
        last = np.searchsorted(ends_of_pieces, ends)
        if not np.array_equal(ends_of_pieces[last], ends):
            raise ValueError("a piece reaches across two stretches")
        letters = codecs.charmap_decode(joined, "strict", self.letters)[0]
        ids: list[int] = []
        cuts = [0, *(marks[_PIECES - 1 : -1 : _PIECES] + 1).tolist(), len(letters)]
        for a, b in zip(cuts, cuts[1:]):
            ids += map(_ID, self.tokenize(letters[a:b]))
        every = np.fromiter(ids, np.uint32, len(ids))
        # as many marks stand before a piece's mark as there are pieces before it
        end = np.flatnonzero(every == self.mark_id)[last] - last
        begin, many = np.empty(n, np.int64), np.empty(n, np.int64)
        begin[order] = np.append(0, end[:-1])
        many[order] = np.diff(end, prepend=0)
        return begin, many, every[every != self.mark_id]

    def _of(self, distinct: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and number of the ids of distinct stretches, and ids."""
        # the smaller of the two is the one to look in
        found = pc.index_in(self.words, value_set=distinct)
        at = np.full(len(distinct), -1)
        at[found.drop_null().to_numpy()] = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        new = distinct.filter(pa.array(at < 0))
        begin, many, flat = self._encoded(new)
        words = pa.concat_arrays([self.words, new])
        begin = np.concatenate([self.begin, begin + len(self.flat)])
        many, flat = np.concatenate([self.many, many]), np.concatenate([self.flat, flat])
        at[at < 0] = np.arange(len(self.words), len(words))
        # beyond some number only those of these texts are kept
        kept = at if len(words) > _KEPT else np.arange(len(words))
        kept = kept[_lengths(words)[kept] <= _KEPT_BYTES]
        self.words, self.many = words.take(pa.array(kept)), many[kept]
        self.begin = np.cumsum(self.many) - self.many
        self.flat = flat[ranges(begin[kept], self.many)]
        return begin[at], many[at], flat

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts that may be put together from stretches."""
        joined = b"".join(texts)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        end = np.cumsum(size)
        # a stretch begins with a text, with white space after a word, and with
        # punctuation after a letter or digit
        raw = np.frombuffer(joined, np.uint8)
        space = _SPACE[raw]
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[1:] |= _PUNCTUATION[raw[1:]] & (_DIGIT[raw] | _ends_letter(raw))[:-1]
        first[(end - size)[size > 0]] = True
        start = np.flatnonzero(first)
        offsets = np.append(start, len(joined)).astype(np.int32)
        every = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
        # equal stretches, byte by byte, are one
        every = every.dictionary_encode()
        begin, many, flat = self._of(every.dictionary)
        which = every.indices.to_numpy()
        count = many[which]
        out = flat[ranges(begin[which], count)].astype("<u4")
        cut = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(start, np.concatenate([[0], end]))].tolist()
        return [out[a:b].tobytes() for a, b in zip(cut, cut[1:])]


def _valid(text: bytes) -> bytes:
    """The text, with replacement characters where it is no UTF-8."""
    if text.isascii():
        return text
    return text.decode("utf-8", "replace").encode()


class Encoder:
    """Ids of texts by a vocabulary of the ``tokenizers`` library, without the
    special tokens that it would add."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task a core
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        spec = json.loads(vocabulary)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model["type"] == "BPE" and spec.get("normalizer") is None and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space") and split.get("use_regex", True)
            and not any(
                model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")
            )
        )
        mark = _mark(model) if plain else None
        #: whether texts may be put together from stretches
        self.by_stretch = mark is not None
        self.special = [x["content"].encode() for x in spec.get("added_tokens", [])]
        self.stretches = _Stretches(self.tokenizer, regex.compile(_SPLIT).findall, mark) if self.by_stretch else None

    def _whole(self, text: bytes) -> bytes:
        found = self.tokenizer.encode(text.decode(), add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def _in_one_go(self, text: bytes) -> bool:
        if not self.by_stretch or any(x in text for x in self.special):
            return True
        if text.isascii() or not any(x in text for x in _WIDE_STARTS):
            return False
        return any(x in text for x in WIDE_SPACE)

    def _long(self, text: bytes) -> bytes:
        out, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + _TOGETHER)
            end = cut.start() if cut else len(text)
            out += self.stretches.ids([text[at:end]])
            at = end
        return b"".join(out)

    def encode(self, texts: Iterable[bytes | memoryview]) -> Iterator[bytes]:
        """The ids of every text, in order, as little-endian 32-bit integers."""
        some: list[bytes] = []
        size = 0
        for view in texts:
            text = _valid(bytes(view))
            odd = self._in_one_go(text)
            if not odd and len(text) < _TOGETHER:
                some.append(text)
                size += len(text)
                if size < _TOGETHER and len(some) < 1 << 16:
                    continue
            if some:
                yield from self.stretches.ids(some)
                some, size = [], 0
            if odd:
                yield self._whole(text)
            elif len(text) >= _TOGETHER:
                yield self._long(text)
        if some:
            yield from self.stretches.ids(some)


@lru_cache(maxsize=1)
def encoder(vocabulary: str) -> Encoder:
    """The encoder a worker keeps for its tasks."""
    return Encoder(vocabulary)

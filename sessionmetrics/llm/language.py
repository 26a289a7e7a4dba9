"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Training counts the hashed n-grams of every labelled document (one pass over
whole texts, counts added up by Spark over (language, slot)); the matrix of
log-probabilities has ``slots`` rows and one column per language, so it does
not grow with the corpus and is sent to every task.  Scoring adds the rows of
a document's n-grams in numpy and reports the largest posterior.

Nulls and edges: a null text, or one without any letter, is ``und`` with
score 0.0; rows with null text or language teach nothing; when nothing can be
learned every document is ``und``.  Repeated rows count and are returned as
often as they occur.  Ties go to the language that sorts first.  Texts of any
length are scored whole, in pieces that overlap by n-1 characters.  An empty
table gives an empty result.  Only the text and the columns ``keep`` are read;
other columns may have any names.  More languages than the matrix bound holds
(2,048) are refused before anything is counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import U, mix

SLOTS = 1 << 14
LONGEST = 3
UNDETERMINED = "und"
MATRIX_BYTES = 256 << 20
_PIECE = 1 << 19
_LETTER = re.compile(r"[^\W\d_]")


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of (row, stretch of its text) of about ``_PIECE`` characters."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text)), _PIECE):
            rows.append(row)
            parts.append(text[at : at + _PIECE + LONGEST - 1])
            size += len(parts[-1]) + LONGEST
            if size >= _PIECE:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


def _slots(parts: list[str], slots: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Slots of the n-grams of 1..LONGEST characters at each position, and
    where each part begins.  Parts are led by blanks, so none runs into the
    next; case is ignored."""
    blank = " " * (LONGEST - 1)
    whole = blank.join(["", *(p.lower() for p in parts), ""])
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
    lengths = np.fromiter((len(p.lower()) for p in parts), np.int64, len(parts)) + len(blank)
    n = int(lengths.sum())
    out, hashed = [], np.zeros(n, U)
    for k in range(LONGEST):
        hashed = hashed * U(0x100000001B3) + codes[k : k + n] + U(1)
        out.append((mix(hashed + U(k)) >> U(32)).astype(np.int64) % slots)
    return out, np.cumsum(lengths) - lengths


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


@dataclass
class Model:
    """Learned languages, log-probabilities (language, slot), log priors."""

    languages: list[str]
    matrix: np.ndarray
    prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, best = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, best
        rows = [i for i, t in enumerate(texts) if has_letter(t)]
        total = np.repeat(self.prior[None, :], len(rows), axis=0)
        slots = self.matrix.shape[1]
        for at, parts in _pieces([texts[i] for i in rows]):
            grams, starts = _slots(parts, slots)
            for lang in range(len(self.languages)):
                got = sum(self.matrix[lang][g] for g in grams)
                np.add.at(total[:, lang], at, np.add.reduceat(got, starts))
        if rows:
            total -= total.max(axis=1, keepdims=True)
            chance = np.exp(total)
            chance /= chance.sum(axis=1, keepdims=True)
            top = chance.argmax(axis=1)
            for i, row in enumerate(rows):
                names[row] = self.languages[top[i]]
            best[rows] = chance[np.arange(len(rows)), top]
        return names, best


def fit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", slots: int = SLOTS, smoothing: float = 0.5
) -> Model:
    """Learn from every row of ``docs`` with a text and a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                mine = [t for t, x in zip(texts, langs) if x == lang and has_letter(t)]
                have = totals.setdefault(lang, np.zeros(slots + 1, np.int64))
                have[slots] += len(mine)  # the last place counts documents
                for _, parts in _pieces(mine):
                    for g in _slots(parts, slots)[0]:
                        have[:slots] += np.bincount(g, minlength=slots)
        for lang, have in totals.items():
            at = np.flatnonzero(have)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(have[at])], names=["lang", "slot", "n"]
            )

    rows = docs.select(F.col(text_col).alias("t"), F.col(lang_col).alias("l")).dropna()
    # no more than the bound allows are counted, and none come to the driver before that is known
    many = MATRIX_BYTES // (slots * 8)
    n_languages = rows.select("l").distinct().limit(many + 1).count()
    if n_languages > many:
        raise ValueError(f"more than {many} languages x {slots} slots exceed the matrix bound")
    # at most (slots + 1) rows per language, whatever the size of the corpus
    counts = (
        rows.mapInArrow(count, "lang string, slot long, n long")
        .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    )
    languages = sorted(counts["lang"].unique())
    table = np.zeros((len(languages), slots + 1))
    table[[languages.index(x) for x in counts["lang"]], counts["slot"].to_numpy(np.int64)] = counts["n"]
    taught = table[:, slots] > 0
    languages, table = [x for x, ok in zip(languages, taught) if ok], table[taught]
    grams = table[:, :slots] + smoothing
    prior = np.log(table[:, slots] / max(1.0, table[:, slots].sum()))
    return Model(languages, np.log(grams / grams.sum(axis=1, keepdims=True)), prior)


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``lang_pred`` and ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, best = sent.value.predict(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(names, pa.string()), pa.array(best)], schema=_arrow(batch.schema)
            )

    def _arrow(schema: pa.Schema) -> pa.Schema:
        return pa.schema([*list(schema)[1:], ("lang_pred", pa.string()), ("score", pa.float64())])

    rows = docs.select(F.col(text_col).alias("_text"), *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, ", ".join(x for x in (fields, "lang_pred string, score double") if x))

"""Token ids in binary files, every document compressed for itself with a
dictionary that all share.

A folder holds

* ``vocabulary.json``: what the ids mean;
* ``dictionary``: a Zstandard dictionary, trained on the serialized ids of
  documents of the corpus (empty if there are too few to train one);
* for every part of the documents, in ascending order of their ids, a file
  ``<part>-<attempt>.tokens``: one Zstandard frame for each document, nothing
  between them, and a file ``<part>-<attempt>.index``: the documents' ids,
  where each frame ends, and how many token ids it holds;
* ``manifest.json``: the format, the width of an id, the SHA-256 of dictionary
  and vocabulary and, in order, the parts with their number of documents and ids and their
  first and last doc_id.

Ids are serialized as little-endian unsigned integers, two bytes wide if the
vocabulary has no more than 65,536 ids, else four.  Any document can be read
without its neighbours: its frame's place is in the index.

The format is a Spark data source (``token_files``).  Tasks encode texts and
write them to files of their own names, so a task that is repeated on another executor leaves the
first one's files aside; the manifest, written last, names the files that
count.  The reader checks the dictionary's hash and opens one part a task;
with the option ``doc_ids`` (``lookup``) it opens only the parts that can hold
those documents, and reads only their frames.

Nulls and edges: a null text is an empty one and holds the end id alone; a
null doc_id comes before all others; rows that share an id are ordered by a
hash of their text; texts of any length are encoded whole, one frame each; an
empty table gives a manifest without parts; other columns are not read, so
their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from .blocks import column_bytes
from .token_ids import encoder

FORMAT = 1
END_ID = 2
#: Bytes of text a part holds, on average.
PART_BYTES = 32 << 20
#: The dictionary is trained on so many documents at most, each of so many
#: bytes at most (longer ones need no dictionary), whatever the corpus.
TRAINING_DOCUMENTS = 1024
TRAINING_BYTES = 16 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
#: Bytes of ids that the reader passes on together, and of texts that a writer gets.
_TOGETHER = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_INDEX = np.dtype([("doc_id", "<i8"), ("null", "?"), ("end", "<u8"), ("n", "<u8")])


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder in any spelling, and its path there."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _read(path: str, name: str) -> bytes:
    system, root = _files(path)
    with system.open_input_file(f"{root}/{name}") as file:
        return file.read()


def _write(path: str, name: str, data: bytes) -> None:
    """Whole or not at all: written aside, then moved."""
    system, root = _files(path)
    system.create_dir(root, recursive=True)
    aside = f"{root}/_{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(aside) as file:
        file.write(data)
    system.move(aside, f"{root}/{name}")


def _manifest(path: str) -> dict | None:
    system, root = _files(path)
    if system.get_file_info(f"{root}/manifest.json").type == pafs.FileType.NotFound:
        return None
    return json.loads(_read(path, "manifest.json"))


def _dictionary(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data) if data else None


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote."""

    part: int
    name: str
    documents: int
    ids: int
    bytes: int
    first: int | None
    last: int | None


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, width: int, end_id: int, overwrite: bool):
        self.path, self.width, self.end_id = path, width, end_id
        self.before = _manifest(path)
        if self.before is not None and not overwrite:
            raise ValueError(f"{path} holds token files already; write with mode overwrite")
        self.dictionary = _read(path, "dictionary")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        import zstandard
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        frames = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(self.dictionary), write_checksum=True)
        encode = encoder(_read(self.path, "vocabulary.json").decode()).encode
        last = np.array([self.end_id], f"<u{self.width}").tobytes()
        system, root = _files(self.path)
        index, end = [], 0
        with system.open_output_stream(f"{root}/{name}.tokens") as out:
            for batch in iterator:
                keys = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
                texts = column_bytes(batch.column(batch.schema.get_field_index("text")))
                rows = np.zeros(len(keys), _INDEX)
                for i, (key, ids) in enumerate(zip(keys, encode(texts))):
                    serialized = np.frombuffer(ids, "<u4").astype(f"<u{self.width}").tobytes() + last
                    end += out.write(frames.compress(serialized))
                    rows[i] = (key or 0, key is None, end, len(serialized) // self.width)
                index.append(rows)
        index = np.concatenate([np.zeros(0, _INDEX), *index])
        if not len(index):
            system.delete_file(f"{root}/{name}.tokens")
            return Part(part, "", 0, 0, 0, None, None)
        _write(self.path, f"{name}.index", index.tobytes())
        ids_there = index["doc_id"][~index["null"]]
        bounds = (int(ids_there.min()), int(ids_there.max())) if len(ids_there) else (None, None)
        return Part(part, name, len(index), int(index["n"].sum()), end, *bounds)

    def commit(self, messages: list[Part | None]) -> None:
        parts = sorted((m for m in messages if m is not None and m.documents), key=lambda m: m.part)
        body = {
            "format": FORMAT, "id_bytes": self.width, "level": LEVEL,
            "dictionary_sha256": hashlib.sha256(self.dictionary).hexdigest(),
            "vocabulary_sha256": hashlib.sha256(_read(self.path, "vocabulary.json")).hexdigest(), "end_id": self.end_id,
            "documents": sum(p.documents for p in parts), "ids": sum(p.ids for p in parts),
            "parts": [
                {"name": p.name, "documents": p.documents, "ids": p.ids, "bytes": p.bytes, "first": p.first, "last": p.last}
                for p in parts
            ],
        }
        _write(self.path, "manifest.json", json.dumps(body, indent=1).encode())
        self._remove(keep={p.name for p in parts})

    def abort(self, messages: list[Part | None]) -> None:
        self._remove(keep={p["name"] for p in (self.before or {}).get("parts", [])})

    def _remove(self, keep: set[str]) -> None:
        """Files of earlier contents and of attempts that came to nothing."""
        system, root = _files(self.path)
        for info in system.get_file_info(pafs.FileSelector(root)):
            stem, _, kind = info.base_name.rpartition(".")
            if kind in ("tokens", "index") and stem not in keep:
                system.delete_file(info.path)


@dataclass
class _Slice(InputPartition):
    """One part to read."""

    name: str
    ids: int
    start: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, wanted: set[int] | None = None):
        self.path, self.manifest = path, _manifest(path)
        if self.manifest is None:
            raise FileNotFoundError(f"{path} holds no finished token files")
        if self.manifest["format"] != FORMAT:
            raise ValueError(f"{path}: unknown format {self.manifest['format']}")
        self.dictionary = _read(path, "dictionary")
        if hashlib.sha256(self.dictionary).hexdigest() != self.manifest["dictionary_sha256"]:
            raise ValueError(f"{path}: the dictionary is not the one the files were written with")
        self.wanted = wanted

    def partitions(self) -> list[_Slice]:
        out, start = [], 0
        for p in self.manifest["parts"]:
            if self.wanted is None or (
                p["first"] is not None and any(p["first"] <= w <= p["last"] for w in self.wanted)
            ):
                out.append(_Slice(p["name"], p["ids"], start))
            start += p["ids"]
        return out

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        import zstandard

        if partition is None:  # a table without parts
            return
        frames = zstandard.ZstdDecompressor(dict_data=_dictionary(self.dictionary))
        width = self.manifest["id_bytes"]
        index = np.frombuffer(_read(self.path, f"{partition.name}.index"), _INDEX)
        end = index["end"].astype(np.int64)
        begin = np.concatenate([[0], end[:-1]])
        n = index["n"].astype(np.int64)
        start = partition.start + np.cumsum(n) - n
        rows = np.arange(len(index))
        if self.wanted is not None:
            rows = rows[np.isin(index["doc_id"], list(self.wanted)) & ~index["null"]]
        system, root = _files(self.path)
        with system.open_input_file(f"{root}/{partition.name}.tokens") as file:
            batch = np.cumsum(n[rows]) * 4 // _TOGETHER
            for some in np.split(rows, np.flatnonzero(np.diff(batch)) + 1):
                ids = []
                for i in some:
                    serialized = frames.decompress(file.read_at(int(end[i] - begin[i]), int(begin[i])))
                    if len(serialized) != n[i] * width:
                        raise ValueError(f"{self.path}/{partition.name}: document {i} does not match its index")
                    ids.append(np.frombuffer(serialized, f"<u{width}").astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(index["doc_id"][some].astype(np.int64), mask=index["null"][some]),
                        pa.array(start[some], pa.int64()), pa.array(n[some], pa.int64()), pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )


class TokenFiles(DataSource):
    """``spark.read.format("token_files").load(path)``; written by ``write``."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        some = self.options.get("doc_ids")
        return _Reader(self.options["path"], None if some is None else {int(i) for i in some.split(",") if i})

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], int(self.options["id_bytes"]), int(self.options["end_id"]), overwrite)


def _short() -> Column:
    return F.octet_length("text").between(1, TRAINING_BYTES)


def _least(rows: DataFrame, n_short: int) -> DataFrame:
    """The (doc_id, text) rows of moderate length whose hash is least.  There
    are ``n_short`` to choose from; few of them have a hash so small that they
    come into question, and only those are sorted."""
    some = rows.where(_short()).withColumn("h", F.xxhash64("doc_id", "text"))
    share = 4 * TRAINING_DOCUMENTS / max(1, n_short)
    below = some.where(F.col("h") < int(share * 2**64) - 2**63) if share < 1 else some
    found = below.orderBy("h", "doc_id").limit(TRAINING_DOCUMENTS).select("text")
    if share < 1 and found.count() < TRAINING_DOCUMENTS:  # many equal rows
        found = some.orderBy("h", "doc_id").limit(TRAINING_DOCUMENTS).select("text")
    return found


def train(rows: DataFrame, vocabulary: str, width: int, end_id: int = END_ID, n_short: int = 0) -> bytes:
    """A dictionary from the (doc_id, text) rows of moderate length whose hash
    is least; empty if they are too few."""
    import zstandard

    texts = column_bytes(_least(rows, n_short).toArrow().column("text"))
    samples = [
        np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id)).astype(f"<u{width}").tobytes()
        for ids in encoder(vocabulary).encode(texts)
    ]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples
        return b""


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Tasks started in here get texts by so many bytes, not by 10,000 rows
    whatever their size."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(_TOGETHER))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def write(
    docs: DataFrame, path: str, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Write the ids of all texts, each followed by ``end_id``, to ``path``
    (a folder all executors reach), and return the table read back from there:
    (doc_id, start, n_tokens, ids), ``start`` being the number of ids before
    the document and ``ids`` little-endian unsigned 32-bit integers.

    The vocabulary file is read by the driver and kept beside the ids."""
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()
    width = 2 if max(encoder(vocabulary).tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else 4
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    n_bytes, n_short = rows.agg(F.sum(F.octet_length("text")), F.count_if(_short())).first()
    _write(path, "vocabulary.json", vocabulary.encode())
    _write(path, "dictionary", train(rows, vocabulary, width, end_id, n_short))
    # rows that share an id are spread by their text, equal rows by their place
    keyed = rows.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("place"))
    keys = ["doc_id", "h", "place"]
    parts = max(1, -(-(n_bytes or 0) // part_bytes))
    ordered = keyed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    spark.dataSource.register(TokenFiles)
    options = {"id_bytes": width, "end_id": end_id}
    with _small_batches(spark):
        ordered.write.format("token_files").options(**options).mode("overwrite").save(path)
    return read(spark, path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a folder written by ``write``."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").load(path)


def lookup(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """The rows of some documents: only their frames are read."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").option("doc_ids", ",".join(map(str, ids))).load(path)

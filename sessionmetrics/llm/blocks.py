"""Blocks of documents, stored once, and exchanges between blocks and buckets.

Operators that compare every stretch of every text move hashes, not texts:

* ``store`` writes the documents as blocks of a few MB into a bucketed table
  in the shared folder; a block is one row and fits a task's memory whatever
  the size of the corpus (a document longer than a block is its own block);
* ``ask`` lets each block send packed numpy columns to hash buckets;
* ``answer`` lets each bucket reply to the blocks that asked;
* ``with_answers`` brings the replies back to their blocks.  The table is
  bucketed by block, so only replies are shuffled, never the texts again.

Blocks reduce their own repeats first: a key held by a third of all rows
reaches its bucket once per block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch

BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 32 << 20
_STORED = "block long, ids binary, offsets binary, data binary"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PACKED = "block long, bucket int, payload binary"


class Block:
    """Documents of one block, ascending by id."""

    def __init__(self, block: int, ids: np.ndarray, offsets: np.ndarray, data: np.ndarray):
        self.block, self.ids, self.offsets, self.data = block, ids, offsets, data

    def __len__(self) -> int:
        return len(self.ids)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length as bytes: the count, then each column."""
    parts = [np.int64(len(columns[0])).tobytes()]
    return b"".join(parts + [np.ascontiguousarray(c).tobytes() for c in columns])


def unpack(payload: bytes, *dtypes) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(payload, np.int64, 1)[0]), 8, []
    for dtype in map(np.dtype, dtypes):
        out.append(np.frombuffer(payload, dtype, n, at))
        at += n * dtype.itemsize
    return out


def squeeze(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers from 0 up, each of its own length: the bytes of
    one weight side by side, without the weights that no value needs, as one
    Zstandard frame.  Sorted columns get short as differences."""
    import zstandard

    parts = []
    for column in columns:
        column = np.ascontiguousarray(column, dtype="<u8")
        width = (int(column.max()).bit_length() + 7) // 8 if len(column) else 0
        parts.append(np.array([len(column), width], "<i8").tobytes())
        parts += [(column >> np.uint64(8 * weight)).astype(np.uint8).tobytes() for weight in range(width)]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unsqueeze(payload: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(payload)
    at, out = 0, []
    while at < len(raw):
        n, width = np.frombuffer(raw, "<i8", 2, at).tolist()
        column = np.zeros(n, np.uint64)
        for weight in range(width):
            some = np.frombuffer(raw, np.uint8, n, at + 16 + n * weight).astype(np.uint64)
            column |= some << np.uint64(8 * weight)
        out.append(column)
        at += 16 + n * width
    return out


def column_bytes(column: pa.Array | pa.ChunkedArray) -> list[memoryview]:
    """Views of a binary column's values; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        return [v for chunk in column.chunks for v in column_bytes(chunk)]
    return [memoryview(b"") if v.as_buffer() is None else memoryview(v.as_buffer()) for v in column]


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    base, seq = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        texts = column_bytes(batch.column(1))
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        part = (np.cumsum(sizes) - sizes) // block_bytes
        for k in np.unique(part):
            rows = np.flatnonzero(part == k)
            rows = rows[np.argsort(ids[rows], kind="stable")]
            data = b"".join(x for i in rows for x in (texts[i], b" "))
            offsets = np.concatenate([[0], np.cumsum(sizes[rows])])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([base + seq], pa.int64()),
                    pa.array([ids[rows].tobytes()], pa.binary()),
                    pa.array([offsets.tobytes()], pa.binary()),
                    pa.array([data], pa.binary()),
                ],
                names=["block", "ids", "offsets", "data"],
            )
            seq += 1


class Blocks:
    """A stored set of blocks (see ``store``)."""

    def __init__(self, table: DataFrame, n_bytes: int, tasks: int, files: int):
        self.table, self.n_bytes, self.tasks, self.files = table, n_bytes, tasks, files

    @property
    def buckets(self) -> int:
        return max(self.tasks, -(-self.n_bytes // BUCKET_BYTES))


def store(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> Blocks:
    """Write ``docs`` as blocks.  Rows whose id is null are left out: nothing
    could refer to them.  A null text is an empty one."""
    spark = docs.sparkSession
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long"), F.col(text_col).cast("binary")
    )
    n_bytes = int(docs.select(F.sum(F.octet_length(text_col))).first()[0] or 0)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = max(tasks, -(-n_bytes // (16 << 20)))
    made = rows.mapInArrow(lambda it: _blocks(it, block_bytes), _STORED)
    return Blocks(_by_block(made, files), n_bytes, tasks, files)


def _by_block(df: DataFrame, files: int) -> DataFrame:
    """``df`` written to the shared folder, bucketed by its column ``block``:
    such tables meet block by block without a shuffle."""
    spark = df.sparkSession
    name = f"llm_blocks_{uuid.uuid4().hex}"
    path = scratch.fresh_dir(spark, "blocks", name)
    (
        df.write.option("compression", "zstd").option("path", path)
        .bucketBy(files, "block").saveAsTable(name)
    )
    return spark.table(name)


def _loaded(table: pa.Table | pa.RecordBatch) -> Iterator[Block]:
    views = {c: column_bytes(table.column(c)) for c in ("ids", "offsets", "data")}
    for i, block in enumerate(table.column("block").to_pylist()):
        yield Block(
            block,
            np.frombuffer(views["ids"][i], np.int64),
            np.frombuffer(views["offsets"][i], np.int64),
            np.frombuffer(views["data"][i], np.uint8),
        )


def _send(block: int, parts: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    parts = list(parts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block] * len(parts), pa.int64()),
            pa.array([p[0] for p in parts], pa.int32()),
            pa.array([p[1] for p in parts], pa.binary()),
        ],
        names=["block", "bucket", "payload"],
    )


def to_buckets(key: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each 64-bit key, from its high bits."""
    return ((key >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def split(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Packed columns for each bucket that has rows."""
    order = np.argsort(bucket, kind="stable")
    sorted_bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(sorted_bucket, prepend=-1))
    for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
        rows = order[lo:hi]
        yield int(sorted_bucket[lo]), pack(*(c[rows] for c in columns))


def ask(blocks: Blocks, fn: Callable[[Block], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """``fn(block)`` yields (bucket, payload)."""

    def run(batches):
        for batch in batches:
            for block in _loaded(batch):
                yield _send(block.block, fn(block))

    return blocks.table.mapInArrow(run, _PACKED)


def ask_again(
    blocks: Blocks, answers: DataFrame, fn: Callable[[Block, dict[int, bytes]], Iterator[tuple[int, bytes]]]
) -> DataFrame:
    """Like ``ask``, for blocks that look at earlier answers first."""
    return with_answers(blocks, answers, lambda b, a: _send(b.block, fn(b, a)), _PACKED)


def answer(asked: DataFrame, fn: Callable[[list[memoryview]], list[bytes]]) -> DataFrame:
    """``fn(payloads)`` gets all payloads of a bucket, in order of their
    blocks, and returns one reply for each."""
    return answer_by_bucket(asked, lambda payloads, bucket: fn(payloads))


def answer_by_bucket(asked: DataFrame, fn: Callable[[list[memoryview], int], list[bytes]]) -> DataFrame:
    """Like ``answer`` with ``fn(payloads, bucket)``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        replies = fn(column_bytes(table.column("payload")), table.column("bucket")[0].as_py())
        return pa.table(
            [table.column("block"), table.column("bucket"), pa.array(replies, pa.binary())],
            names=["block", "bucket", "payload"],
        )

    return asked.groupBy("bucket").applyInArrow(run, _PACKED)


def with_answers(
    blocks: Blocks,
    answers: DataFrame,
    fn: Callable[[Block, dict[int, bytes]], pa.RecordBatch],
    schema: str,
) -> DataFrame:
    """``fn(block, replies by bucket)`` returns the block's output rows."""
    empty = pa.table(
        [pa.array([], t) for t in (pa.int64(), pa.int32(), pa.binary())],
        names=["block", "bucket", "payload"],
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right if right.num_rows else empty
        replies = dict(zip(right.column("bucket").to_pylist(), column_bytes(right.column("payload"))))
        return pa.Table.from_batches([fn(b, replies) for b in _loaded(left)])

    # a block without replies still has its row on the left
    return (
        blocks.table.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(run, schema)
    )


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Actions in here remove their shuffle files when they end, not when the
    driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def kept_by_block(blocks: Blocks, answers: DataFrame) -> DataFrame:
    """Replies stored like the blocks, one row (block, replies) each, for
    exchanges that need them more than once.  A block has at most one reply
    from each bucket.  Once they are stored, the exchange's shuffle files go."""
    rows = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "payload")).alias("replies"))
    with _shuffles_removed(answers.sparkSession):
        return _by_block(rows, blocks.files)


def joined(
    blocks: Blocks, kept: list[DataFrame], fn: Callable[[Block, dict[int, bytes]], pa.RecordBatch], schema: str
) -> DataFrame:
    """``fn(block, replies by bucket)`` with the replies of all ``kept``
    tables (their bucket numbers must differ)."""
    rows, n_kept = blocks.table, len(kept)
    for i, table in enumerate(kept):
        rows = rows.join(table.withColumnRenamed("replies", f"replies{i}"), "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                replies: dict[int, bytes] = {}
                for j in range(n_kept):
                    bucket, payload = row.column(f"replies{j}").flatten().flatten()
                    replies.update(zip(bucket.to_pylist(), column_bytes(payload)))
                for block in _loaded(row):
                    yield fn(block, replies)

    return rows.mapInArrow(run, schema)


def ask_joined(
    blocks: Blocks, kept: list[DataFrame], fn: Callable[[Block, dict[int, bytes]], Iterator[tuple[int, bytes]]]
) -> DataFrame:
    """Like ``ask``, for blocks that look at stored replies first."""
    return joined(blocks, kept, lambda b, r: _send(b.block, fn(b, r)), _PACKED)


def rewritten(
    blocks: Blocks, kept: list[DataFrame], fn: Callable[[Block, dict[int, bytes]], pa.RecordBatch]
) -> Blocks:
    """Blocks stored anew, with what ``fn(block, replies by bucket)`` makes of
    their contents; those of before are not read again."""
    made = joined(blocks, kept, fn, _STORED)
    return Blocks(_by_block(made, blocks.files), blocks.n_bytes, blocks.tasks, blocks.files)

"""A corpus from raw documents to packed sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``.  ``run`` writes each stage's result as
Parquet to the cluster's shared folder, rereads it for the next, and removes
what is read no more.

1. language: documents without a letter, or whose language stays uncertain,
   go;
2. near_duplicates: of documents whose SimHash fingerprints are linked, the
   one with the smallest id stays;
3. repeated_passages: words of windows that an earlier document has are cut
   from the text; documents of which nothing is left go;
4. mixture: each document is repeated as often as the source mix takes it;
5. sequences: the pieces of all documents with their place in the sequences.

A document is a row, not an id: rows that share an id, or have none, are
compared, kept, cut and repeated each for itself.  Where ids decide, rows that
share one are ordered by a hash of their text, and rows without one come last.

Other columns pass through untouched, whatever their names; ``n_chars``,
where present, follows the text.  An empty table gives empty results.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionmetrics.llm import difference_cover, language, mixing, packing, scratch, simhash
from sessionmetrics.llm.queries import vocabulary
from sessionmetrics.llm.shipping import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A predicted language below this posterior is uncertain.
CERTAIN = 0.5

ORACLE_SQL = None


def _as_row(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): the documents with all their columns set aside,
    so that no name can clash with an operator's."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))


def _columns(rows: DataFrame, names: list[str], text=None) -> DataFrame:
    """The documents' own columns again, with another text if given."""
    out = []
    for name in names:
        value = F.col("_row")[name]
        if text is not None and name == "text":
            value = text
        elif text is not None and name == "n_chars":
            value = F.length(text).cast(rows.schema["_row"].dataType[name].dataType)
        out.append(value.alias(name))
    return rows.select(*out)


def _keyed(docs: DataFrame) -> DataFrame:
    """``_as_row`` with a key of their own for all rows, ascending with the id.

    Ids that are all there and all different are such keys.  Else the rows are
    sorted by id and written with their places; those of one id are spread by
    a hash of the text, equal ones by where they stood."""
    rows = _as_row(docs)
    held = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if held.where(F.col("doc_id").isNull() | (F.col("n") > 1)).isEmpty():
        return rows.withColumn("_key", F.col("doc_id").cast("long"))
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    names = [f"_by{i}" for i in range(len(order))]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("*", *(c.alias(n) for c, n in zip(order, names)))
    rows = rows.repartitionByRange(parts, *names).sortWithinPartitions(*names).drop(*names)
    return scratch.written(rows.withColumn("_key", F.monotonically_increasing_id()), "keyed")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs)
    found = language.identify(_as_row(docs), model, keep=("_row",))
    if model.languages:
        certain = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= CERTAIN)
    else:  # nothing to learn from: only texts without a letter are rejected
        certain = F.col("_row.text").rlike(r"\p{L}")
    return _columns(found.where(certain), docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _keyed(docs)
    found = simhash.near_duplicates(rows.select("_key", "text"), id_col="_key")
    first = found.where(F.col("id") == F.col("component")).select("id")
    return _columns(rows.join(first, F.col("_key") == F.col("id")), docs.columns)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    found = difference_cover.remove_repeats(keyed.select("_key", "text"), id_col="_key").where(F.col("n_removed") > 0)
    changed = found.select("id", F.col("kept").cast("string").alias("_kept"))
    rows = keyed.join(changed, F.col("_key") == F.col("id"), "left")
    text = F.coalesce(F.col("_kept"), F.col("_row.text"))
    return _columns(rows.where(F.col("_kept").isNull() | (F.col("_kept") != "")), docs.columns, text)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    mixed = mixing.mix_sources(keyed.select("_key", "text", F.col("_row.source").alias("source")), id_col="_key")
    mixed = mixed.where(F.col("copies") > 0).select("id", "copies")
    rows = keyed.join(mixed, F.col("_key") == F.col("id"))
    times = rows.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return _columns(times, docs.columns)


def sequence_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = packing.pieces(docs, vocabulary())
    cut = cut.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(cut).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def _shipped(stage: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("language", _shipped(language_stage)),
    ("near_duplicates", _shipped(near_duplicate_stage)),
    ("repeated_passages", _shipped(passage_stage)),
    ("mixture", _shipped(mixture_stage)),
    ("sequences", _shipped(sequence_stage)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows."""
    docs, before = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")), None
    for name, stage in STAGES:
        with scratch.owned() as result:
            with scratch.owned() as inside:
                rows = stage(spark, docs, sf_dir)
            docs = scratch.written(rows, f"stage-{name}")
        # only the last stage's result has to stay
        inside.remove(spark)
        if before is not None:
            before.remove(spark)
        before = result
    return docs

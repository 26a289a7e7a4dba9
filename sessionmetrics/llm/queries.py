"""One query per operator, over its whole table with production parameters.

Each query is a thin wrapper: the operator does the work, the query names the
columns and derives digests.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    cross_polytope,
    difference_cover,
    hilbert,
    language,
    lexical,
    mixing,
    packing,
    resampling,
    run_length,
    scratch,
    simhash,
    spelling,
    suffix_tree,
    token_files,
)
from .shipping import ship

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def learned_from(modulus: int) -> Column:
    """Rows a model may learn from: crc32 of the id's text, modulo, is not 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus != 2, F.lit(False))


def _remainder_is_two(ids, modulus: int):
    return np.fromiter((zlib.crc32(str(i).encode()) % modulus == 2 for i in ids.tolist()), bool, len(ids))


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = suffix_tree.score(table(spark, sf_dir, "documents"), lambda ids: _remainder_is_two(ids, 7))
    return scored.withColumnRenamed("id", "doc_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


#: As many documents are drawn as weigh what this part of the targets weighs.
TARGETS_KEPT = 0.99


def op3_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    good = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id")
    drawn = resampling.resample(table(spark, sf_dir, "documents"), good, targets_kept=TARGETS_KEPT)
    return drawn.withColumnRenamed("id", "doc_id")


def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cross_polytope.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def op5_hilbert_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hilbert.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op6_run_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_length.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = difference_cover.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def vocabulary() -> str:
    """The public vocabulary whose ids are packed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), vocabulary())
    cut = cut.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(cut).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(learned_from(4)))
    held_out = docs.withColumn("held_out", ~learned_from(4))
    found = language.identify(held_out, model, keep=("doc_id", "held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_dir(spark, "token-files")
    stored = token_files.write(table(spark, sf_dir, "documents"), path, vocabulary())
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES: dict[str, Query] = {
    "op1_suffix_tree": op1_suffix_tree,
    "op2_simhash": op2_simhash,
    "op3_quality_resampling": op3_quality_resampling,
    "op4_cross_polytope": op4_cross_polytope,
    "op5_hilbert_search": op5_hilbert_search,
    "op6_run_length": op6_run_length,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_packing": op8_packing,
    "op9_language": op9_language,
    "op10_mixing": op10_mixing,
    "op11_spelling": op11_spelling,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_files": op13_token_files,
}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(query) for name, query in QUERIES.items()}

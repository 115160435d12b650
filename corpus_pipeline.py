"""The corpus pipeline: documents of a known language, without copies, mixed and packed.

Each stage reads the documents that its predecessor kept and hands on their columns; the last
one returns packed pieces.  SQL can express neither the compressor nor the tokenizer; the chain
is tested against a plain Python version.

Defined results: NULL, empty and letterless texts go in the first stage; of equal texts and of a group of
near ones a single row stays, chosen by length, then doc_id, then address; rows that repeat a doc_id
are else rows of their own; an empty table gives an empty result; columns of any other name come through
as they are up to the last stage; texts are taken whole, however long.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityloom.llm import exact_dedup, language, mixing, packing, simhash
from entityloom.llm.common import small_batches, staged_rows, word_count

ORACLE_SQL: str | None = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those whose two best languages are close."""
    small_batches(spark)
    return language.accepted_rows(docs, language.dictionaries(docs, F.lit(True)))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the longest of equal texts, white space aside."""
    return exact_dedup.without_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near fingerprints."""
    small_batches(spark)
    return simhash.without_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents up to their source's target; those taken twice are two rows."""
    return mixing.mixed_documents(docs, word_count(F.col("text")), F.col("source"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in sequences."""
    small_batches(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(packing.token_pieces(docs, path, end_id=0, keep=False))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("mix_sources", mix),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged_rows(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

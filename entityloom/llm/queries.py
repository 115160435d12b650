"""The queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityloom.llm import alignment, conversations, dac, decontamination, exact_dedup, language, line_frequency, mixing, packing, pseudonyms, quality, repeats, simhash
from entityloom.llm.common import addressed, read_documents, staged_rows, with_uid, word_count

#: For trials on synthetic data only; a caller passes a key of its own from a secret store.
TRIAL_KEY = "trial-key-not-for-production"


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    return pseudonyms.pseudonymised(docs, TRIAL_KEY)


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.line_rules(read_documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(read_documents(spark, sf_dir))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select(
        "doc_id", word_count(F.col("text")).alias("size"), mixing.pattern_of(F.col("source")).alias("pattern")
    )
    drawn, facts = mixing.standard_mix(staged_rows(with_uid(docs), "mix-sizes"))
    keyed = facts.withColumn("pattern", mixing.pattern_of(F.col("source"))).drop("source")
    return drawn.join(keyed, "pattern").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken")
    )


def op5_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return dac.read_tokens(dac.write_tokens(read_documents(spark, sf_dir), path, end_id=2))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(*addressed(read_documents(spark, sf_dir)))
    return found.select("doc_id", "fingerprint", "component_id")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.duplicates(*addressed(read_documents(spark, sf_dir)))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    held_out = language.held_out(F.col("doc_id"), folds=3, fold=1)
    content = language.dictionaries(docs, ~held_out)
    return language.identified(docs, content, F.col("doc_id"), held_out.alias("held_out"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(packing.token_pieces(read_documents(spark, sf_dir), path, end_id=0))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = language.held_out(F.col("doc_id"), folds=5, fold=0)
    model = quality.learned(docs, labels, ~held_out)
    scores = quality.scored(docs, model, F.col("doc_id"), held_out.alias("held_out"))
    return scores.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contamination(read_documents(spark, sf_dir), items).drop("spans")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.aligned(read_documents(spark, sf_dir), *paths)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversations.repairs_with_digest(rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_pseudonyms": op1_pii_pseudonyms,
    "op2_line_frequency": op2_line_frequency,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_mix_sources": op4_mix_sources,
    "op5_token_codes": op5_token_codes,
    "op6_simhash": op6_simhash,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_decontamination": op11_decontamination,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL: dict[str, str] = {
    "op2_line_frequency": line_frequency.sql(),
    "op7_exact_dedup": exact_dedup.SQL,
    "op11_decontamination": decontamination.SQL,
}

"""The named queries of this folder, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from emberline.llm import (
    alignment, co_training, content_sort, factors, language, mixing, orchard, packing, pages, repeats, rules, simhash,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = rules.build_ledger(table(spark, sf_dir, "documents"))
    return rules.apply_policy(ledger).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed_bits",
    )


def op2_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co_training.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return content_sort.grouped(docs, "doc_id", "text", F.col("doc_id"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors.remove_duplicates(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op11_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.compress(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_co_training": op2_co_training,
    "op3_simhash": op3_simhash,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_main_text": op5_main_text,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_mixing": op8_mixing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_orchard_codes": op11_orchard_codes,
    "op12_token_alignment": op12_token_alignment,
    "op13_language": op13_language,
}

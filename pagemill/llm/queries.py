"""The queries of this subpackage and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import chat, decontaminate, mixing, near_dups, ngram_ratio, personal_data, quality_model, substring_dedup, token_counts, token_files
from pagemill.llm.common import load


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(load(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.over_limit(load(spark, sf_dir, "documents"), tokenizer())


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(load(spark, sf_dir, "documents"))


def op4_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.scored_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_components(load(spark, sf_dir, "documents"), threshold=85, width=3)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.with_probe(spark, load(spark, sf_dir, "conversations")))


def op7_ngram_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_ratio.judged(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encoded_documents(load(spark, sf_dir, "documents"), tokenizer())


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.reported(load(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_source_mix, op2_token_counts, op3_substring_dedup, op4_quality_scores, op5_near_duplicates, op6_chat_format, op7_ngram_rules, op8_benchmark_leaks, op9_token_files, op10_personal_data)}
ORACLE_SQL: dict[str, str] = {"op6_chat_format": chat.SQL}

"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, compression, decontaminate, license_scan, line_dedup, near_dup, oracle, pii, quality, substring, suffix_array
from .common import documents, tune

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def tokenizer() -> tuple[str, str]:
    """Path and pattern of the public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(documents(spark, sf_dir), *tokenizer())


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op4_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(documents(spark, sf_dir))


def op6_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(documents(spark, sf_dir), line_dedup.RUNS)


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.dedup(documents(spark, sf_dir))


def op8_compression_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.score(documents(spark, sf_dir))


def op9_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rank(documents(spark, sf_dir), tune(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.digest(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_byte_bpe, op2_decontamination, op3_license_scan, op4_pii_spans, op5_substring_dedup, op6_line_chunks, op7_suffix_array_dedup, op8_compression_rules, op9_quality_ranking, op10_near_duplicates)}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express."""
    return dict(oracle.SQL)

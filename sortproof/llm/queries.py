"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sortproof.llm import (
    ann,
    bpe,
    divergence_audit,
    line_dedup,
    mixing,
    near_dup,
    quality_rules,
    sharding,
    site_quality,
    substring_dedup,
    token_codes,
    toxicity,
    vector_codes,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_digest(table(spark, sf_dir, "documents"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules_digest(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = bpe.Codec.from_file(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.bpe_digest(table(spark, sf_dir, "documents"), codec)


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_dup_digest(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharding_digest(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_digest(table(spark, sf_dir, "documents"))


def op8_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.site_quality_digest(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), table(spark, sf_dir, "pages")
    )


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.ann_digest(table(spark, sf_dir, "embeddings"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup_digest(table(spark, sf_dir, "documents"))


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit.divergence_audit(table(spark, sf_dir, "documents"))


def op12_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_codes.token_files_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes_digest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_rules": op2_quality_rules,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_near_dup": op4_near_dup,
    "op5_sharding": op5_sharding,
    "op6_mixing": op6_mixing,
    "op7_line_dedup": op7_line_dedup,
    "op8_site_quality": op8_site_quality,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_divergence_audit": op11_divergence_audit,
    "op12_token_codes": op12_token_codes,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE: dict[str, str] = {
    "op7_line_dedup": line_dedup.LINE_DEDUP_SQL,
    "op10_substring_dedup": substring_dedup.SUBSTRING_DEDUP_SQL,
    "op11_divergence_audit": divergence_audit.DIVERGENCE_AUDIT_SQL,
    "op13_vector_codes": vector_codes.VECTOR_CODES_SQL,
}

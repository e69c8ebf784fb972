"""The corpus pipeline: quality rules, line dedup, near-duplicates, source mixing, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet in the shared folder and
read again for the next stage.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sortproof.llm import bpe, line_dedup, mixing, near_dup, quality_rules
from sortproof.session import scratch_path

#: The vocabulary of the last stage.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.keep_good(docs)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; documents stay."""
    return line_dedup.remove_frequent_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return near_dup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with what they decode to as a hash."""
    return bpe.bpe_digest(docs, bpe.Codec.from_file(VOCABULARY, public_tokenizers.PATTERN))


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_common_lines),
    ("near_dup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: EM, sampling by hash and byte-pair merges have no SQL form; the tests check run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

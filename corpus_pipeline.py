"""Corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept,
and returns a DataFrame; between stages the documents are written as Parquet
and read again.  All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold.llm import bpe, jaccard, lines, mixing, quality
from lakefold.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the current policy go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go from the texts; documents without any other line go."""
    left = lines.drop_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("bigint"))
    return left.filter(r"text rlike '[^\\x20\\x09-\\x0D]'")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the smallest doc_id stays."""
    return jaccard.representatives(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or taken once or twice, so that sources meet their targets."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, counted and digested, and the digest of the decoded text."""
    import public_tokenizers
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("source mix", source_mix),
    ("byte-level BPE", tokens),
]

#: The rounding of the mix and the merges of the encoder are not SQL; tests/llm holds them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)

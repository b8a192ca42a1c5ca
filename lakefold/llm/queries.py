"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakefold.llm import bpe, fingerprint, jaccard, langid, lines, mixing, oracle, pii, quality, runs, secrets, suffixes, trie, warc
from lakefold.llm.common import table


def op1_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def op2_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_report(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op5_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op6_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.round_trip(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op11_recompression_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_report(table(spark, sf_dir, "documents"))


def op12_monoid_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie_report(table(spark, sf_dir, "conversations"))


def op13_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sparse_suffixes": op1_sparse_suffixes,
    "op2_scaled_sketch": op2_scaled_sketch,
    "op3_quality_rules": op3_quality_rules,
    "op4_line_dedup": op4_line_dedup,
    "op5_entropy_mix": op5_entropy_mix,
    "op6_crf_language": op6_crf_language,
    "op7_warc": op7_warc,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_secret_scan": op10_secret_scan,
    "op11_recompression_runs": op11_recompression_runs,
    "op12_monoid_trie": op12_monoid_trie,
    "op13_skip_chain_pii": op13_skip_chain_pii,
}

ORACLE = {
    "op3_quality_rules": oracle.QUALITY,
    "op4_line_dedup": oracle.LINES,
    "op7_warc": oracle.WARC,
    "op12_monoid_trie": oracle.TRIE,
}

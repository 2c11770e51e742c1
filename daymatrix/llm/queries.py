"""Registered queries of the subpackage: each applies one operator, with its
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from daymatrix.llm import (
    bpe_words, collocations, conversation_trie, edit_counts, gray_simhash, host_rules, jaccard_prefix, kd_shards, ordinal_quality,
    qgram_decontam, secret_scan, suffix_dedup, zstd_language,
)
from daymatrix.llm.common import benchmark, conversations, documents, labels
from pyspark.sql import functions as F


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal_quality.rate_documents(documents(spark, sf_dir), labels(spark, sf_dir))


def op2_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zstd_language.identify_languages(documents(spark, sf_dir))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.host_rules(documents(spark, sf_dir)).drop("host", "shrunk_rate")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(documents(spark, sf_dir))


def op5_qgram_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qgram_decontam.find_leaks(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.kd_shards(documents(spark, sf_dir), n_shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op8_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_words.round_trip(documents(spark, sf_dir))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_prefix.near_duplicates(documents(spark, sf_dir))


def op10_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("edits", edit_counts.sample_edits())
    return edit_counts.count_with_edits(docs, keep_text=False).drop("text_after")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(conversations(spark, sf_dir))


def op13_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gray_simhash.near_duplicates(documents(spark, sf_dir))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: fn
    for fn in (op1_ordinal_quality, op2_zstd_language, op3_host_rules, op4_suffix_dedup, op5_qgram_decontam, op6_kd_shards,
               op7_secret_scan, op8_bpe_words, op9_ngram_jaccard, op10_edit_counts, op11_collocations, op12_conversation_trie, op13_gray_simhash)
} | {"pipeline": corpus_pipeline.run}

SQL: dict[str, str] = {
    "op3_host_rules": f"""WITH {host_rules.ORACLE_RULES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged""",
    "op11_collocations": collocations.oracle_sql(),
    "op12_conversation_trie": conversation_trie.ORACLE,
}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

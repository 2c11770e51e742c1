"""From raw documents to token ids, in five stages.

Each stage takes what the one before kept, written as Parquet and read again,
and its decisions take effect: rejected documents go, one document of each
near-duplicate group stays, documents that hold a benchmark item go, secrets are
masked in the text, and the rest is encoded. All but the last return the
columns of ``documents``.

Defined cases: rows with a null id cannot be told apart and pass the
near-duplicate and benchmark stages; repeated rows of an id are one document, of
which one row stays (the one whose text has the smallest hash); the operators
define the rest.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daymatrix.llm import bpe_words, host_rules, jaccard_prefix, qgram_decontam, secret_scan  # noqa: E402
from daymatrix.llm.common import benchmark, documents, one_row_an_id, small_batches, without, written  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or their host's verdict rejects go."""
    small_batches(spark)
    return host_rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id
    stays."""
    small_batches(spark)
    classes = jaccard_prefix.near_components(docs)
    first = classes.where("doc_id = component_id").select("doc_id").distinct()
    known = docs.where(F.col("doc_id").isNotNull()).join(first, "doc_id", "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
    return one_row_an_id(known).unionByName(docs.where(F.col("doc_id").isNull()))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget go."""
    small_batches(spark)
    leaks = qgram_decontam.find_leaks(docs, benchmark(spark, sf_dir)).select("doc_id").distinct()
    return without(docs, leaks, "doc_id").select(*(F.col(f"`{c}`") for c in docs.columns))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; no document goes."""
    small_batches(spark)
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text
    decoded from them."""
    small_batches(spark)
    return bpe_words.round_trip(docs, keep_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scan", mask_secrets),
    ("BPE encoding", encode),
]

#: SQL cannot express the encoding; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs

"""Host-level quality rules.

Per document, word and line counts give a base verdict and four soft rules
(symbol share, repeated lines, repeated three-word windows, word length). A
host (``source``) is judged by the share of its documents that break a rule:
the share is shrunk towards the corpus by a beta prior fitted to all hosts
(method of moments), and a host whose posterior is surely above
``max_failure_rate`` is rejected with all its documents.

Defined cases: a null text has no words and fails the base rule; a null host
is a host of its own that is never rejected (it names no site); repeated rows
count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.llm.common import free_name, map_rows, without, written
from daymatrix.llm.kernels import SpanHash, chunks, is_space, per_row_sum, windows, words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


@dataclass(frozen=True)
class RuleLimits:
    """Limits of the rules. ``max_failure_rate`` and ``z`` decide on hosts:
    a host goes when its posterior failure rate less ``z`` posterior standard
    deviations exceeds the limit."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_symbols_per_word_pct: int = 100
    max_dup_lines: int = 30
    max_word_chars: int = 25
    max_failure_rate: float = 0.5
    z: float = 3.0


def _dup_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            n += line in seen
            seen.add(line)
    return n


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column(2)
        for lo, hi, data, off in chunks(text):
            start, end, first = words(data, off)
            in_word = ((data & 0xC0) != 0x80) & ~is_space(data)
            gram, at_word, at = windows(SpanHash(data)(start, end), first, 3)
            covered = np.zeros(len(start) + 3, bool)
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                if b - a > 1:
                    _, where, n = np.unique(gram[a:b], return_inverse=True, return_counts=True)
                    twice = at_word[a:b][n[where] > 1]
                    for k in range(3):
                        covered[twice + k] = True
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).slice(lo, hi - lo),
                "host": batch.column(1).slice(lo, hi - lo),
                "n_words": pa.array(np.diff(first), pa.int64()),
                "word_chars": pa.array(per_row_sum(in_word, off), pa.int64()),
                "n_symbols": pa.array(per_row_sum(SYMBOLS[data], off), pa.int64()),
                "n_dup_lines": pa.array([_dup_lines(x) for x in text.slice(lo, hi - lo).to_pylist()], pa.int64()),
                "n_repeat_words": pa.array(per_row_sum(covered[: len(start)], first), pa.int64()),
            })


def measure(docs: DataFrame) -> DataFrame:
    """One row of counts per document; only these leave the scan."""
    schema = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return docs.select("doc_id", F.col("source").cast("string").alias("host"), "text").mapInArrow(_measure, schema)


def with_rules(counts: DataFrame, limits: RuleLimits) -> DataFrame:
    """Base verdict and whether any rule fails."""
    base = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_pct * F.col("n_words"))
    soft = (
        (100 * F.col("n_symbols") > limits.max_symbols_per_word_pct * F.col("n_words"))
        | (F.col("n_dup_lines") > limits.max_dup_lines)
        | (F.col("word_chars") > limits.max_word_chars * F.col("n_words"))
    )
    return counts.withColumn("base_failed", base).withColumn("failed", base | soft)


def host_verdicts(ruled: DataFrame, limits: RuleLimits) -> DataFrame:
    """``host, n_docs, n_failed, shrunk_rate, host_rejected``.

    The beta prior has the mean and variance of the hosts' raw rates; without
    spread (one host, equal rates) it falls back to one pseudo-document at the
    mean rate.
    """
    hosts = ruled.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_samp(rate).alias("v")).first()  # one row: the fitted prior
    m, v = prior["m"] or 0.0, prior["v"] or 0.0
    w = max(m * (1 - m) / v - 1, 1.0) if v > 1e-9 else 1.0
    alpha, beta = m * w + F.col("n_failed"), (1 - m) * w + F.col("n_docs") - F.col("n_failed")
    mean = alpha / (alpha + beta)
    spread = F.sqrt(mean * (1 - mean) / (alpha + beta + 1))
    return (
        hosts.withColumn("shrunk_rate", mean)
        .withColumn("host_rejected", F.col("host").isNotNull() & (mean - limits.z * spread > limits.max_failure_rate))
        .select("host", "n_docs", "n_failed", "shrunk_rate", "host_rejected")
    )


def host_rules(docs: DataFrame, limits: RuleLimits = RuleLimits()) -> DataFrame:
    """Verdict per document: its counts, ``base_failed``, the host's shrunk
    failure rate and ``kept``. Expects ``doc_id``, ``source`` and ``text``."""
    ruled = written(with_rules(measure(docs), limits), "host-rules")
    verdicts = host_verdicts(ruled, limits)
    # Hosts may be many: Spark broadcasts the verdicts only if they turn out
    # small, and else splits a hot host's documents over several tasks.
    rejected = verdicts.withColumnRenamed("host", "v_host")
    return (
        ruled.join(rejected, F.col("host").eqNullSafe(F.col("v_host")), "left")
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False)))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed", "kept", "host", "shrunk_rate")
    )


def keep_documents(docs: DataFrame, limits: RuleLimits = RuleLimits()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns. The base rule is
    applied in the scan; of the hosts only the rejected ones are joined."""
    hosts = host_verdicts(written(with_rules(measure(docs), limits), "host-rules"), limits)
    names = docs.columns
    host = free_name("rejected_host", names)
    rejected = hosts.where("host_rejected").select(F.col("host").alias(host))

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nothing = pa.nulls(len(batch), pa.int64())
            view = pa.RecordBatch.from_arrays(
                [nothing, nothing.cast(pa.string()), batch.column(names.index("text"))], ["doc_id", "host", "text"])
            at = 0
            for part in _measure([view]):  # one chunk of rows at a time
                n, repeat = part["n_words"].to_numpy(), part["n_repeat_words"].to_numpy()
                ok = ~((n < limits.min_words) | (100 * repeat > limits.max_repeat_pct * n))
                yield batch.slice(at, len(n)).filter(pa.array(ok))
                at += len(n)

    kept = map_rows(docs, passing)
    return without(kept, rejected, F.col("source").cast("string") == F.col(host)).select(*(F.col(f"`{c}`") for c in names))


ORACLE_RULES = r"""
word_rows AS (
  SELECT rid, doc_id, source, text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM (SELECT *, row_number() OVER () AS rid FROM documents)
),
grams AS (
  SELECT rid, i, list_aggregate(ws[i : i + 2], 'string_agg', chr(1)) AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM word_rows WHERE len(ws) >= 3)
),
repeated AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1
  ) GROUP BY rid
),
lines AS (
  SELECT rid, sum(c - 1) AS n FROM (
    SELECT rid, line, count(*) AS c
    FROM (SELECT rid, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM word_rows)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line
  ) GROUP BY rid
),
counts AS (
  SELECT w.rid, w.doc_id, w.source AS host, w.text, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM word_rows w LEFT JOIN lines l USING (rid) LEFT JOIN repeated r USING (rid)
),
ruled AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 100 * n_words
           OR n_dup_lines > 30 OR word_chars > 25 * n_words AS failed
  FROM counts
),
hosts AS (SELECT host, count(*) AS n_docs, sum(CAST(failed AS INTEGER)) AS n_failed FROM ruled GROUP BY host),
prior AS (
  SELECT m, CASE WHEN v > 1e-9 THEN greatest(m * (1 - m) / v - 1, 1.0) ELSE 1.0 END AS w
  FROM (SELECT avg(n_failed / n_docs) AS m, coalesce(var_samp(n_failed / n_docs), 0.0) AS v FROM hosts)
),
posterior AS (SELECT host, m * w + n_failed AS a, (1 - m) * w + n_docs - n_failed AS b FROM hosts, prior),
verdicts AS (
  SELECT host AS v_host, a / (a + b) AS rate,
         host IS NOT NULL AND a / (a + b) - 3.0 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) > 0.5 AS rejected
  FROM posterior
),
judged AS (
  SELECT r.*, rate, NOT base_failed AND NOT rejected AS kept
  FROM ruled r JOIN verdicts ON host IS NOT DISTINCT FROM v_host
)"""


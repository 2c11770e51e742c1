"""Incremental runs over a daily-counts store.

Two write modes, never mixed on one store:

* **recount** (default, I1/I2): the store is partitioned by month; a run reads
  the source from the start of the month holding ``hwm - lookback_days``,
  recounts those whole months and replaces exactly those partitions. Replaying a run, or loading A then B, gives
  the same store as loading A and B at once, and a day first loaded partially
  ends at its full count (X12).
* **additive** (I4/J10): batches whose days are disjoint from everything
  stored are appended as ``batch_id`` partitions and summed on read; the
  writer refuses a batch that touches a stored day.

Rows dated after ``as_of`` or before ``min_valid`` are left out of every run, so
a wrong date can neither be counted nor move the watermark.

A recount run is one commit record (``sources.commits``): it writes its months
beside the store, under ``_runs``, and then the record that names them together
with the new watermark. From that moment the run has happened: readers take these
months from there, and the next step moves their folders to their partitions. A run that
ended before the record left the store and the watermark as they were; one that
ended after it is finished by the next run, or by :func:`apply_pending`. The
watermark is the recorded one, compared at the start of a run with the greatest
day stored (one partition is read): a store that ends before its watermark has
lost days, and the run raises instead of leaving a gap. A store without records
goes by its data. Runs on one store take turns: of two side by side the second to
commit raises.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymatrix.schema import COUNT_KEY
from daymatrix.sources import commits
from daymatrix.sources.store import BATCH_COL, append_batch, drop_partitions, partition_values, read_staging

PERIOD_COL = "period"
RUNS = "_runs"


class StateError(RuntimeError):
    """The store ends before its recorded watermark."""


@dataclass
class RunInfo:
    hwm_before: dt.date | None
    read_from: dt.date | None
    hwm_after: dt.date | None


@dataclass(frozen=True)
class RunState:
    """What the last recount run recorded."""

    last_loaded_date: dt.date | None = None
    updated_at: dt.datetime | None = None


@dataclass(frozen=True)
class Pending:
    """A recorded run whose months are not in their partitions yet."""

    run: int
    fresh: list[str]
    gone: list[str]

    def folder(self, store_path: str) -> str:
        return f"{store_path}/{RUNS}/{self.run}"


def load_run_state(spark: SparkSession, path: str) -> RunState:
    """The recorded state of a recount store; empty for a store without records."""
    known = commits.snapshot(spark, path).extra.get("state", {})
    day, at = known.get("last_loaded_date"), known.get("updated_at")
    return RunState(day and dt.date.fromisoformat(day), at and dt.datetime.fromisoformat(at))


def _pending(snap: commits.Snapshot) -> Pending | None:
    known = snap.extra.get("pending")
    return Pending(**known) if known else None


def stored_periods(spark: SparkSession, path: str) -> list[dt.date]:
    """Months that the store holds, from its partition folders."""
    return sorted(dt.date.fromisoformat(v) for v in partition_values(spark, path, PERIOD_COL))


def stored_hwm(spark: SparkSession, path: str, day_col: str = "day") -> dt.date | None:
    """Greatest stored day, or ``None`` for an empty store."""
    periods = stored_periods(spark, path)
    return _last_day(spark, path, periods[-1], day_col) if periods else None


def _last_day(spark: SparkSession, path: str, period: dt.date, day_col: str) -> dt.date | None:
    last = spark.read.parquet(path).where(F.col(PERIOD_COL) == F.lit(period))
    return last.agg(F.max(day_col).alias("m")).first()["m"]


def _raw_bound(df: DataFrame, raw_date_col: str, d: dt.date):
    """A literal of the raw column's type, so the comparison stays on the raw
    column and reaches the Parquet scan as a pushed filter."""
    return F.lit(d).cast(df.schema[raw_date_col].dataType)


def _hwm(spark: SparkSession, store_path: str, day_col: str) -> dt.date | None:
    """The watermark a run goes on from: the recorded one, or that of the data
    where there is none or the data go further."""
    recorded, stored = load_run_state(spark, store_path).last_loaded_date, stored_hwm(spark, store_path, day_col)
    if recorded is not None and (stored is None or stored < recorded):
        raise StateError(f"the record says {recorded}, the store ends at {stored}: restore it, or load all again into a new store")
    return stored


def stage_recount(source: DataFrame, raw_date_col: str, build_counts: Callable[[DataFrame], DataFrame],
                  store_path: str, as_of: dt.date, lookback_days: int = 0, min_valid: dt.date | None = None,
                  day_col: str = "day", run_at: dt.datetime | None = None) -> RunInfo:
    """Write and record one recount run; :func:`apply_pending` moves its months."""
    spark = source.sparkSession
    apply_pending(spark, store_path)
    seen = commits.snapshot(spark, store_path)
    hwm = _hwm(spark, store_path, day_col)
    until = as_of + dt.timedelta(days=1)
    rows = source.where(F.col(raw_date_col) < _raw_bound(source, raw_date_col, until))
    if min_valid is not None:
        rows = rows.where(F.col(raw_date_col) >= _raw_bound(source, raw_date_col, min_valid))
    read_from = None
    if hwm is not None:
        read_from = (hwm - dt.timedelta(days=lookback_days) + dt.timedelta(days=1)).replace(day=1)
        rows = rows.where(F.col(raw_date_col) >= _raw_bound(source, raw_date_col, read_from))
    counts = build_counts(rows)
    if read_from is not None:
        counts = counts.where(F.col(day_col) >= F.lit(read_from))
    months = stored_periods(spark, store_path)
    before = [p for p in months if read_from is not None and p >= read_from]
    run = commits.claim(spark, store_path)
    staged = f"{store_path}/{RUNS}/{run}"
    # Rebalance on the period: rows of a month are clustered into few files,
    # and AQE splits a month that is too large for one task (no sampling pass).
    (counts.withColumn(PERIOD_COL, F.trunc(day_col, "MM"))
        .hint("rebalance", PERIOD_COL)
        .write.partitionBy(PERIOD_COL).parquet(staged))
    fresh = stored_periods(spark, staged)
    gone = [p for p in before if p not in set(fresh)]
    if fresh:
        after = stored_hwm(spark, staged, day_col)
    else:
        left = [p for p in months if p not in set(gone)]
        after = _last_day(spark, store_path, left[-1], day_col) if left else None
    record = {
        "state": {"last_loaded_date": after and after.isoformat(), "updated_at": run_at and run_at.isoformat()},
        "pending": {"run": run, "fresh": [p.isoformat() for p in fresh], "gone": [p.isoformat() for p in gone]},
    }

    def change(now: commits.Snapshot):
        if now.version != seen.version:
            raise commits.CommitConflict("another run came first")
        return now.live, {**now.extra, **record}

    commits.commit(spark, store_path, change)
    return RunInfo(hwm, read_from, after)


def _staged_periods(spark: SparkSession, store_path: str, todo: Pending) -> list[str]:
    """Months of a recorded run that are still beside the store: one that is no
    longer there has been moved."""
    there = set(partition_values(spark, todo.folder(store_path), PERIOD_COL))
    return [p for p in todo.fresh if p in there]


def apply_pending(spark: SparkSession, store_path: str) -> int | None:
    """Move the months of a recorded run to their partitions, by renaming their
    folders (no row is read again); one that ended half way is gone on with.
    Returns the run, or ``None`` if there is none."""
    todo = _pending(commits.snapshot(spark, store_path))
    if todo is None:
        return None
    for period in _staged_periods(spark, store_path, todo):
        fs, source = commits.file_system(spark, f"{todo.folder(store_path)}/{PERIOD_COL}={period}")
        _, target = commits.file_system(spark, f"{store_path}/{PERIOD_COL}={period}")
        fs.delete(target, True)
        if not fs.rename(source, target):
            raise OSError(f"{source} could not be moved to {target}")
    drop_partitions(spark, store_path, PERIOD_COL, todo.gone)

    def change(now: commits.Snapshot):
        if now.extra.get("pending", {}) != vars(todo):
            raise commits.CommitConflict(f"run {todo.run} has been applied by another")
        return now.live, {k: v for k, v in now.extra.items() if k != "pending"}

    commits.commit(spark, store_path, change)
    # Also what runs that ended before their record left there.
    fs, folder = commits.file_system(spark, f"{store_path}/{RUNS}")
    fs.delete(folder, True)
    return todo.run


def run_recount(source: DataFrame, raw_date_col: str, build_counts: Callable[[DataFrame], DataFrame],
                store_path: str, as_of: dt.date, lookback_days: int = 0, min_valid: dt.date | None = None,
                day_col: str = "day", run_at: dt.datetime | None = None) -> RunInfo:
    """One recount run (I1, I2) over the source rows dated ``min_valid`` to
    ``as_of``, both included. Months read again are replaced as a whole: one
    that has no rows left goes from the store. The watermark and ``run_at`` are
    recorded with the data (I3)."""
    info = stage_recount(source, raw_date_col, build_counts, store_path, as_of, lookback_days, min_valid, day_col, run_at)
    apply_pending(source.sparkSession, store_path)
    return info


def read_recount_store(spark: SparkSession, store_path: str) -> DataFrame:
    """All counts as of the last recorded run."""
    todo = _pending(commits.snapshot(spark, store_path))
    if todo is None:
        return spark.read.parquet(store_path).drop(PERIOD_COL)
    staged = _staged_periods(spark, store_path, todo)
    replaced = {*staged, *todo.gone}
    kept = [p.isoformat() for p in stored_periods(spark, store_path) if p.isoformat() not in replaced]
    parts = []
    if kept:
        parts.append(spark.read.option("basePath", store_path).parquet(*(f"{store_path}/{PERIOD_COL}={p}" for p in kept)))
    if staged:
        folder = todo.folder(store_path)
        parts.append(spark.read.option("basePath", folder).parquet(*(f"{folder}/{PERIOD_COL}={p}" for p in staged)))
    if not parts:
        return spark.read.parquet(store_path).where("false").drop(PERIOD_COL)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return rows.drop(PERIOD_COL)


class OverlappingBatchError(ValueError):
    pass


def add_disjoint_batch(counts: DataFrame, store_path: str, day_col: str = "day") -> int:
    """Append a batch of counts whose days are all new (I4)."""
    spark = counts.sparkSession
    known = bool(partition_values(spark, store_path, BATCH_COL))

    def all_new(batch: DataFrame) -> None:
        if not known and not commits.snapshot(spark, store_path).version:
            return
        stored_days = read_staging(spark, store_path).select(day_col).distinct()
        clash = batch.select(day_col).distinct().join(stored_days, day_col, "left_semi")
        if not clash.isEmpty():
            raise OverlappingBatchError("batch has days already stored; use run_recount")

    return append_batch(counts, store_path, check=all_new)


def read_additive_store(spark: SparkSession, store_path: str, keys=tuple(COUNT_KEY), value: str = "n") -> DataFrame:
    """Sum of all appended partial counts per key."""
    return read_staging(spark, store_path).drop(BATCH_COL).groupBy(*keys).agg(
        F.sum(value).cast("long").alias(value)
    )

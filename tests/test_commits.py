"""Commit records: readers see whole states, writers never merge."""
import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from daymatrix.session import scratch_path
from daymatrix.sources import commits, store

D = dt.date


def _batch(spark, rows):
    return spark.createDataFrame(rows, "k STRING, day DATE, n INT").coalesce(1)


def _sum(spark, path):
    return store.read_staging(spark, path).agg(F.sum("n")).first()[0]


def test_compaction_switches_at_once(spark, monkeypatch):
    """Until the one commit a reader sees the old batches, then the new one; a
    frame read before it can still be computed after it."""
    path = scratch_path(spark, "t-atomic")
    store.append_batch(_batch(spark, [("a", D(2024, 1, 1), 5), ("b", D(2024, 1, 1), 7)]), path)
    store.append_batch(_batch(spark, [("a", D(2024, 1, 1), 6)]), path)
    seen = []
    real = commits.replace

    def watched(*args, **kwargs):
        seen.append(_sum(spark, path))   # the new batch is written, not committed
        before = store.read_staging(spark, path)
        real(*args, **kwargs)
        seen.append(_sum(spark, path))
        seen.append(before.agg(F.sum("n")).first()[0])

    monkeypatch.setattr(commits, "replace", watched)
    store.compact_staging(spark, path, ["k", "day"])
    assert seen == [18, 13, 18]


def test_interrupted_writers_leave_no_trace(spark, monkeypatch):
    path = scratch_path(spark, "t-interrupted")
    store.append_batch(_batch(spark, [("a", D(2024, 1, 1), 5)]), path)

    def dies(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", dies)
        with pytest.raises(OSError):
            store.append_batch(_batch(spark, [("a", D(2024, 1, 2), 100)]), path)
        with pytest.raises(OSError):
            store.compact_staging(spark, path, ["k", "day"])
    assert _sum(spark, path) == 5
    assert store.append_batch(_batch(spark, [("a", D(2024, 1, 2), 1)]), path) == 4  # ids 2 and 3 are not given again
    assert _sum(spark, path) == 6


def test_writers_side_by_side(spark):
    path = scratch_path(spark, "t-writers")
    with ThreadPoolExecutor(6) as pool:
        ids = list(pool.map(lambda i: store.append_batch(_batch(spark, [(f"k{i}", D(2024, 1, i + 1), 1 << i)]), path, ts_col="day"), range(6)))
    assert sorted(ids) == [1, 2, 3, 4, 5, 6]
    assert _sum(spark, path) == 63
    assert commits.snapshot(spark, path).version == 6


def test_a_batch_is_written_once(spark):
    path = scratch_path(spark, "t-once")
    store.append_batch(_batch(spark, [("a", D(2024, 1, 1), 1)]), path, batch_id=7)
    with pytest.raises(commits.CommitConflict, match="batch 7"):
        store.append_batch(_batch(spark, [("a", D(2024, 1, 1), 1)]), path, batch_id=7)
    assert _sum(spark, path) == 1


def test_append_during_a_compaction_stays_and_keeps_its_turn(spark, monkeypatch):
    path = scratch_path(spark, "t-meanwhile")
    day = D(2024, 1, 1)
    store.append_batch(_batch(spark, [("a", day, 1), ("b", day, 1), ("b", day, 2)]), path)
    late = commits.claim(spark, path)   # a writer that has its id (2) but is slow
    store.append_batch(_batch(spark, [("a", day, 3)]), path)
    real = commits.replace

    def meanwhile(*args, **kwargs):
        monkeypatch.setattr(commits, "claim", lambda *a: late)
        store.append_batch(_batch(spark, [("a", day, 20), ("b", day, 20)]), path)
        return real(*args, **kwargs)

    monkeypatch.setattr(commits, "replace", meanwhile)
    store.compact_staging(spark, path, ["k", "day"])
    latest = {r.k: r.n for r in store.load_staging(spark, path, ["k", "day"]).collect()}
    assert latest == {"a": 3, "b": 20}  # batch 3 is after batch 2, that after batch 1


def test_two_compactions(spark, monkeypatch):
    path = scratch_path(spark, "t-two")
    for n in (1, 2):
        store.append_batch(_batch(spark, [("a", D(2024, 1, n), n)]), path)
    real = commits.replace

    def other_first(*args, **kwargs):
        monkeypatch.setattr(commits, "replace", real)
        store.compact_staging(spark, path, ["k", "day"])
        return real(*args, **kwargs)

    monkeypatch.setattr(commits, "replace", other_first)
    with pytest.raises(commits.CommitConflict, match="no longer live"):
        store.compact_staging(spark, path, ["k", "day"])
    assert _sum(spark, path) == 3


def test_manifest_without_reading_the_store(spark):
    path = scratch_path(spark, "t-manifest")
    loaded = dt.datetime(2024, 5, 1, 6)
    store.append_batch(_batch(spark, [("a", D(2024, 1, 1), 1), ("b", None, 2), ("c", D(2024, 2, 1), 2)]), path, ts_col="day", loaded_at=loaded)
    store.append_batch(_batch(spark, []), path, ts_col="day")
    store.append_batch(_batch(spark, [("a", D(2024, 3, 1), 1)]), path, ts_col="day")
    man = store.stored_manifest(spark, path, "day")
    assert "Scan parquet" not in man._jdf.queryExecution().executedPlan().toString()
    scanned = store.manifest(store.read_staging(spark, path, keep_meta=True), "day").select(*man.columns)
    assert sorted(map(tuple, man.collect()), key=lambda r: r[0]) == sorted(map(tuple, scanned.collect()), key=lambda r: r[0])
    # A batch without the column's figures is read, the others are not.
    store.append_batch(_batch(spark, [("a", D(2024, 4, 1), 1)]), path)
    assert [r.max_timestamp for r in store.stored_manifest(spark, path, "day").orderBy("batch_id").collect()] == [D(2024, 2, 1), D(2024, 3, 1), D(2024, 4, 1)]


def test_retention_and_vacuum(spark):
    import os

    path = scratch_path(spark, "t-vacuum")
    for m in (1, 2, 6):
        store.append_batch(_batch(spark, [("a", D(2024, m, 1), m)]), path, ts_col="day")
    assert store.apply_retention(spark, path, "day", D(2024, 6, 30), 90) == [1, 2]
    assert _sum(spark, path) == 6
    folder = path.removeprefix("file:")
    assert os.path.isdir(f"{folder}/batch_id=1")           # for readers that began before
    assert store.vacuum(spark, path) == []                 # retired by the last commit
    store.append_batch(_batch(spark, [("a", D(2024, 7, 1), 1)]), path, ts_col="day")
    assert store.vacuum(spark, path) == [1, 2] and not os.path.isdir(f"{folder}/batch_id=1")
    assert _sum(spark, path) == 7
    assert store.drop_batches(spark, path, [3, 99]) == [3]
    assert store.drop_batches(spark, path, [4]) == [4]
    assert store.read_staging(spark, path).count() == 0     # a store without live batches keeps its columns
    assert store.read_staging(spark, path).columns == ["k", "day", "n", "batch_id"]


def test_schema_is_registered_at_append(spark):
    path = scratch_path(spark, "t-schema")
    store.append_batch(spark.createDataFrame([("a", 1)], "k STRING, `x.1` INT"), path)
    store.append_batch(spark.createDataFrame([("b", 2.5)], "k STRING, y DOUBLE"), path)
    got = store.read_staging(spark, path)
    assert got.columns == ["k", "x.1", "y", "batch_id"]
    assert sorted(map(tuple, got.collect())) == [("a", 1, None, 1), ("b", None, 2.5, 2)]
    with pytest.raises(ValueError, match="column y is double"):
        store.append_batch(spark.createDataFrame([("c", "text")], "k STRING, y STRING"), path)
    assert store.read_staging(spark, path).count() == 2


def test_folders_of_another_tool(spark):
    path = scratch_path(spark, "t-adopt")
    spark.createDataFrame([("a", 1, 3), ("a", 2, 5)], "k STRING, n INT, batch_id INT").write.partitionBy("batch_id").parquet(path)
    with pytest.raises(FileNotFoundError, match="adopt_batches"):
        store.read_staging(spark, path)
    assert store.adopt_batches(spark, path) == [3, 5]
    store.append_batch(spark.createDataFrame([("b", 9)], "k STRING, n INT"), path)
    assert sorted((r.k, r.n) for r in store.load_staging(spark, path, ["k"]).collect()) == [("a", 2), ("b", 9)]

"""Months are moved, appended batches are written once."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymatrix.plans import incremental as inc
from daymatrix.session import scratch_path
from daymatrix.sources import commits
from daymatrix.sources.store import append_batch, read_staging

D = dt.date


def _files(spark, path, inside=None):
    fs, p = commits.file_system(spark, path)
    found = fs.listFiles(p, True)
    out = {}
    while found.hasNext():
        f = found.next()
        name = str(f.getPath())
        if name.endswith(".parquet") and (inside is None or inside in name):
            out[name.rsplit("/", 1)[1]] = f.getLen()
    return out


def _source(spark, *days):
    return spark.createDataFrame([(d, "a") for d in days], "ts DATE, k STRING")


def _count(rows):
    return rows.groupBy(F.col("ts").alias("day"), "k").agg(F.count(F.lit(1)).alias("n"))


DAYS = [D(2024, 1, 5), D(2024, 2, 3), D(2024, 3, 9), D(2024, 3, 9)]


def test_months_are_moved_and_not_written_again(spark):
    path = scratch_path(spark, "t-moved")
    inc.stage_recount(_source(spark, *DAYS), "ts", _count, path, D(2024, 12, 31))
    staged = _files(spark, path, inc.RUNS)
    inc.apply_pending(spark, path)
    assert staged and _files(spark, path) == staged
    assert inc.read_recount_store(spark, path).agg(F.sum("n")).first()[0] == 4


def test_move_that_ends_between_two_months(spark):
    path = scratch_path(spark, "t-half-moved")
    inc.stage_recount(_source(spark, *DAYS), "ts", _count, path, D(2024, 12, 31))
    want = sorted(map(tuple, inc.read_recount_store(spark, path).select("day", "n").collect()))
    fs, source = commits.file_system(spark, f"{path}/{inc.RUNS}/1/period=2024-02-01")
    _, target = commits.file_system(spark, f"{path}/period=2024-02-01")
    assert fs.rename(source, target)
    for _ in range(2):
        assert sorted(map(tuple, inc.read_recount_store(spark, path).select("day", "n").collect())) == want
        inc.apply_pending(spark, path)
    assert inc.stored_periods(spark, path) == [D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1)]


def test_disjoint_batch_is_written_once(spark):
    path = scratch_path(spark, "t-once")
    counts = _count(_source(spark, *DAYS))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("t-once", "append")
    try:
        append_batch(counts, scratch_path(spark, "t-plain"))
        plain = len(tracker.getJobIdsForGroup("t-once"))
        inc.add_disjoint_batch(counts, path)
        assert len(tracker.getJobIdsForGroup("t-once")) == 2 * plain
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    before = _files(spark, path)
    with pytest.raises(inc.OverlappingBatchError):
        inc.add_disjoint_batch(_count(_source(spark, D(2024, 3, 9), D(2024, 4, 1))), path)
    assert _files(spark, path) == before and read_staging(spark, path).count() == 3
    inc.add_disjoint_batch(_count(_source(spark, D(2024, 4, 1))), path)
    assert read_staging(spark, path).count() == 4


def test_store_without_record_is_not_appended_to(spark):
    path = scratch_path(spark, "t-foreign")
    counts = _count(_source(spark, *DAYS))
    counts.write.parquet(f"{path}/batch_id=7")
    with pytest.raises(FileNotFoundError):
        inc.add_disjoint_batch(counts, path)

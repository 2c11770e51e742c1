"""Recount runs that end at any point, and what they record."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymatrix.plans import daily
from daymatrix.plans import incremental as inc
from daymatrix.session import scratch_path
from daymatrix.sources import commits

D = dt.date
AS_OF = D(2024, 12, 31)
JANUARY, MARCH = D(2024, 1, 31), D(2024, 3, 31)


def _source(spark, *days):
    return spark.createDataFrame([(d, "a") for d in days], "ts DATE, k STRING")


def _count(rows):
    return rows.groupBy(F.col("ts").alias("day"), "k").agg(F.count(F.lit(1)).alias("n"))


def _stored(spark, path):
    return sorted((r.day, r.n) for r in inc.read_recount_store(spark, path).collect())


DAYS = [D(2024, 1, 5), D(2024, 1, 20), D(2024, 2, 3), D(2024, 3, 9), D(2024, 3, 9)]
ALL = [(D(2024, 1, 5), 1), (D(2024, 1, 20), 1), (D(2024, 2, 3), 1), (D(2024, 3, 9), 2)]


def test_run_that_ends_before_its_record(spark):
    path = scratch_path(spark, "t-before-record")
    src = _source(spark, *DAYS)
    inc.run_recount(src, "ts", _count, path, JANUARY)
    seen = commits.snapshot(spark, path)
    # The months are written, the record is not.
    left = commits.claim(spark, path)
    _count(src).withColumn("period", F.trunc("day", "MM")).write.partitionBy("period").parquet(f"{path}/{inc.RUNS}/{left}")
    assert _stored(spark, path) == ALL[:2]
    assert commits.snapshot(spark, path) == seen
    assert inc.load_run_state(spark, path).last_loaded_date == D(2024, 1, 20)
    info = inc.run_recount(src, "ts", _count, path, AS_OF)
    assert info.hwm_before == D(2024, 1, 20) and _stored(spark, path) == ALL
    fs, runs = commits.file_system(spark, f"{path}/{inc.RUNS}")
    assert not fs.exists(runs)


@pytest.mark.parametrize("half_way", [False, True])
def test_run_that_ends_before_its_months_are_moved(spark, half_way, monkeypatch):
    path = scratch_path(spark, "t-after-record")
    inc.run_recount(_source(spark, *DAYS), "ts", _count, path, D(2024, 2, 28))
    at = dt.datetime(2024, 4, 1, 6)
    # February is empty when it is read again, March is new.
    later = _source(spark, DAYS[0], DAYS[1], DAYS[3], DAYS[4])
    expect = [ALL[0], ALL[1], ALL[3]]
    info = inc.stage_recount(later, "ts", _count, path, MARCH, run_at=at)
    assert info == inc.RunInfo(D(2024, 2, 3), D(2024, 2, 1), D(2024, 3, 9))
    assert _stored(spark, path) == expect
    assert inc.load_run_state(spark, path) == inc.RunState(D(2024, 3, 9), at)
    if half_way:
        def stop(*args):
            raise OSError("lost")

        with monkeypatch.context() as m:
            m.setattr(inc, "drop_partitions", stop)
            with pytest.raises(OSError):
                inc.apply_pending(spark, path)
        assert _stored(spark, path) == expect
    # The next run finishes it and goes on from its watermark.
    more = later.unionByName(_source(spark, D(2024, 4, 2)))
    info = inc.run_recount(more, "ts", _count, path, AS_OF)
    assert (info.hwm_before, info.read_from) == (D(2024, 3, 9), D(2024, 3, 1))
    assert _stored(spark, path) == expect + [(D(2024, 4, 2), 1)]
    assert sorted((r.day, r.n) for r in spark.read.parquet(path).collect()) == _stored(spark, path)
    assert inc.apply_pending(spark, path) is None


def test_runs_side_by_side(spark):
    path = scratch_path(spark, "t-two-writers")
    src = _source(spark, *DAYS)
    inc.run_recount(src, "ts", _count, path, JANUARY)

    def meanwhile(rows):
        inc.run_recount(src, "ts", _count, path, MARCH)
        return _count(rows)

    with pytest.raises(commits.CommitConflict, match="another run came first"):
        inc.run_recount(src, "ts", meanwhile, path, D(2024, 2, 28))
    assert _stored(spark, path) == ALL
    assert inc.load_run_state(spark, path).last_loaded_date == D(2024, 3, 9)


def test_lost_days_stop_the_next_run(spark):
    path = scratch_path(spark, "t-lost-days")
    src = _source(spark, *DAYS)
    inc.run_recount(src, "ts", _count, path, MARCH)
    fs, month = commits.file_system(spark, f"{path}/period=2024-03-01")
    fs.delete(month, True)
    with pytest.raises(inc.StateError, match="the store ends at 2024-02-03"):
        inc.run_recount(src, "ts", _count, path, AS_OF)
    assert daily.StateError is inc.StateError


def test_store_without_records_goes_by_its_data(spark):
    path = scratch_path(spark, "t-no-records")
    src = _source(spark, *DAYS)
    _count(src.where(F.col("ts") <= F.lit(JANUARY))).withColumn("period", F.trunc("day", "MM")).write.partitionBy("period").parquet(path)
    assert inc.load_run_state(spark, path) == inc.RunState()
    info = inc.run_recount(src, "ts", _count, path, AS_OF)
    assert info.hwm_before == D(2024, 1, 20) and _stored(spark, path) == ALL


def test_run_without_rows(spark):
    path = scratch_path(spark, "t-no-rows")
    src = _source(spark, *DAYS)
    inc.run_recount(src, "ts", _count, path, AS_OF)
    info = inc.run_recount(src.where("ts < DATE'2024-03-01'"), "ts", _count, path, AS_OF)  # March is read again, and empty
    assert info.hwm_after == D(2024, 2, 3) == inc.load_run_state(spark, path).last_loaded_date
    assert _stored(spark, path) == ALL[:3]

"""Streaming daily counts across several micro-batches."""
import datetime as dt

from daymatrix.session import scratch_path
from daymatrix.streaming.daily_counts import run_daily_counts

SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _ev(i, day, hour, kind):
    return (i, dt.datetime(2024, 1, day, hour), 1, kind, 1.0, "{}")


def test_day_split_over_micro_batches(spark):
    src = scratch_path(spark, "t-stream-src")
    first = [_ev(1, 1, 8, "view"), _ev(2, 1, 9, "view"), _ev(3, 2, 1, "view"), _ev(4, 2, 2, "click")]
    second = [_ev(5, 2, 20, "view"), _ev(6, 3, 5, "view"), _ev(7, 2, 23, "click")]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.parquet(f"{src}/a")
    spark.createDataFrame(second, SCHEMA).coalesce(1).write.parquet(f"{src}/b")
    out = run_daily_counts(spark, f"{src}/*/*.parquet", spark.read.parquet(f"{src}/a").schema,
                           scratch_path(spark, "t-stream-sink"), scratch_path(spark, "t-stream-ckpt"),
                           max_files_per_trigger=1)
    got = sorted((r.day.isoformat(), r.event_type, r.n) for r in out.collect())
    assert got == [("2024-01-01", "view", 2), ("2024-01-02", "click", 2), ("2024-01-02", "view", 2),
                   ("2024-01-03", "view", 1)]


def test_rows_later_than_a_day_count(spark):
    src = scratch_path(spark, "t-late-src")
    for i, day in enumerate([9, 1, 5, 1]):
        spark.createDataFrame([_ev(i, day, 8, "view")], SCHEMA).coalesce(1).write.parquet(f"{src}/{i}")
    out = run_daily_counts(spark, f"{src}/*/*.parquet", spark.read.parquet(f"{src}/0").schema,
                           scratch_path(spark, "t-late-sink"), scratch_path(spark, "t-late-ckpt"), max_files_per_trigger=1)
    assert sorted((r.day.day, r.n) for r in out.collect()) == [(1, 2), (5, 1), (9, 1)]


def _feed(spark, src, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{src}/{name}")


def test_compaction_between_triggers(spark):
    from daymatrix.sources.store import partition_values
    from daymatrix.streaming.daily_counts import compact_daily_counts, read_daily_counts

    src, sink, ckpt = (scratch_path(spark, f"t-compact-{n}") for n in ("src", "sink", "ckpt"))
    for i in range(4):
        _feed(spark, src, f"a{i}", [_ev(i, i + 1, 8, "view"), _ev(10 + i, 1, 9, "view")])
    schema = spark.read.parquet(f"{src}/a0").schema

    def run():
        run_daily_counts(spark, f"{src}/*/*.parquet", schema, sink, ckpt, max_files_per_trigger=1)

    def counts():
        return sorted((r.day.day, r.n) for r in read_daily_counts(spark, sink).collect())

    run()
    want = [(1, 5), (2, 1), (3, 1), (4, 1)]
    assert counts() == want
    before = read_daily_counts(spark, sink)            # a reader from before the switch
    assert compact_daily_counts(spark, sink) == 2 and counts() == want
    assert sorted((r.day.day, r.n) for r in before.collect()) == want
    assert compact_daily_counts(spark, sink) is None and counts() == want
    for i in range(2):
        _feed(spark, src, f"b{i}", [_ev(20 + i, 9, 8, "view")])
    run()
    want = sorted([*want, (9, 2)])
    assert counts() == want
    assert compact_daily_counts(spark, sink) == 4 and counts() == want
    assert [e for e in map(int, partition_values(spark, sink, "epoch")) if 0 <= e <= 2] == []


def test_replayed_batch_after_a_compaction_counts_once(spark):
    from daymatrix.streaming.daily_counts import _store, compact_daily_counts, read_daily_counts

    sink = scratch_path(spark, "t-replay-sink")
    write = _store(sink, "ts", "event_type")
    batches = [spark.createDataFrame([_ev(i, 1, 8, "view")], SCHEMA) for i in range(3)]
    for i, b in enumerate(batches):
        write(b, i)
    compact_daily_counts(spark, sink)
    write(batches[2], 2)  # the newest batch was not acknowledged
    assert [r.n for r in read_daily_counts(spark, sink).collect()] == [3]


def test_interrupted_compaction_counts_once(spark, monkeypatch):
    import pytest

    from daymatrix.sources import commits
    from daymatrix.streaming.daily_counts import _store, compact_daily_counts, read_daily_counts

    sink = scratch_path(spark, "t-lost-sink")
    write = _store(sink, "ts", "event_type")
    for i in range(3):
        write(spark.createDataFrame([_ev(i, 1, 8, "view")], SCHEMA), i)
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            compact_daily_counts(spark, sink)
    assert [r.n for r in read_daily_counts(spark, sink).collect()] == [3]
    assert compact_daily_counts(spark, sink) == 1
    assert [r.n for r in read_daily_counts(spark, sink).collect()] == [3]

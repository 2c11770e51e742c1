"""Latest wins, retention and idempotent increments (FIXTURES 4.4)."""
import datetime as dt

from pyspark.sql import functions as F

from daymatrix.operators.dedup import latest_wins
from daymatrix.plans import incremental as inc
from daymatrix.session import scratch_path
from daymatrix.sources import store

D = dt.date
AS_OF = D(2024, 12, 31)


def test_latest_wins(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), "A09", "00012", 3, 1), (D(2024, 1, 1), "A09", "00012", 5, 2)],
                               "day DATE, code STRING, up STRING, n BIGINT, batch_id INT")
    out = latest_wins(df, ["day", "code", "up"], "batch_id").collect()
    assert [(r.n, r.batch_id) for r in out] == [(5, 2)]


def test_retention_cutoff(spark):
    man = spark.createDataFrame([(1, D(2001, 8, 7)), (2, D(2001, 8, 6)), (3, D(2001, 11, 1))],
                                "batch_id INT, max_timestamp DATE")
    keep = {r.batch_id: r.keep for r in store.retention_flags(man, D(2001, 11, 5), 90).collect()}
    assert keep == {1: True, 2: False, 3: True}


def test_staging_append_manifest_and_drop(spark):
    path = scratch_path(spark, "t-staging")
    a = spark.createDataFrame([(D(2001, 8, 1), "x", 1)], "day DATE, k STRING, n BIGINT")
    b = spark.createDataFrame([(D(2001, 11, 1), "x", 2), (D(2001, 11, 2), "y", 3)], "day DATE, k STRING, n BIGINT")
    assert store.append_batch(a, path) == 1
    assert store.append_batch(b, path) == 2
    man = {r.batch_id: (r.num_rows, r.max_timestamp) for r in store.manifest(store.read_staging(spark, path), "day").collect()}
    assert man == {1: (1, D(2001, 8, 1)), 2: (2, D(2001, 11, 2))}
    assert store.apply_retention(spark, path, "day", D(2001, 11, 5), 90) == [1]
    assert store.read_staging(spark, path).count() == 2
    latest = store.load_staging(spark, path, ["k"]).orderBy("k").collect()
    assert [(r.k, r.n) for r in latest] == [("x", 2), ("y", 3)]


def _rows(spark, spec):
    return spark.createDataFrame([(D(2024, 1, d), k) for d, k in spec], "ts DATE, k STRING")


def _count(rows):
    return rows.groupBy(F.col("ts").alias("day"), "k").agg(F.count(F.lit(1)).alias("n"))


def _stored(spark, path):
    return sorted((r.day, r.k, r.n) for r in inc.read_recount_store(spark, path).collect())


def test_increments_are_idempotent(spark):
    src = _rows(spark, [(1, "a"), (2, "a"), (2, "b"), (3, "a"), (3, "a")])
    full = scratch_path(spark, "t-full")
    inc.run_recount(src, "ts", _count, full, AS_OF)
    expect = _stored(spark, full)
    two = scratch_path(spark, "t-two")
    inc.run_recount(src, "ts", _count, two, D(2024, 1, 2), lookback_days=1)
    inc.run_recount(src, "ts", _count, two, AS_OF, lookback_days=1)
    assert _stored(spark, two) == expect
    inc.run_recount(src, "ts", _count, two, AS_OF, lookback_days=1)  # replay
    assert _stored(spark, two) == expect


def test_partial_day_then_full(spark):
    path = scratch_path(spark, "t-partial")
    partial = _rows(spark, [(5, "a")] * 2)
    inc.run_recount(partial, "ts", _count, path, AS_OF)
    full = _rows(spark, [(5, "a")] * 7)
    inc.run_recount(full, "ts", _count, path, AS_OF)
    assert _stored(spark, path) == [(D(2024, 1, 5), "a", 7)]


def test_future_row_neither_counts_nor_moves_the_watermark(spark):
    path = scratch_path(spark, "t-future")
    rows = spark.createDataFrame([(D(2024, 1, 5), "a"), (D(2099, 1, 1), "a")], "ts DATE, k STRING")
    assert inc.run_recount(rows, "ts", _count, path, D(2024, 1, 31)).hwm_after == D(2024, 1, 5)
    more = spark.createDataFrame([(D(2024, 1, 5), "a"), (D(2024, 2, 5), "a"), (D(2024, 3, 5), "a")], "ts DATE, k STRING")
    inc.run_recount(more, "ts", _count, path, D(2024, 3, 31))
    assert [r[0] for r in _stored(spark, path)] == [D(2024, 1, 5), D(2024, 2, 5), D(2024, 3, 5)]


def test_emptied_month_goes(spark):
    path = scratch_path(spark, "t-emptied")
    rows = spark.createDataFrame([(D(2024, 1, 5), "a"), (D(2024, 2, 5), "a")], "ts DATE, k STRING")
    inc.run_recount(rows, "ts", _count, path, AS_OF)
    inc.run_recount(rows.where("ts < DATE'2024-02-01'"), "ts", _count, path, AS_OF, lookback_days=40)
    assert _stored(spark, path) == [(D(2024, 1, 5), "a", 1)]


def test_last_appended_row_wins_within_a_batch(spark):
    path = scratch_path(spark, "t-ties")
    store.append_batch(spark.createDataFrame([("a.b", 3), ("a.b", 1), ("a.b", 2)], "`k.x` STRING, n INT").coalesce(1), path)
    assert [(r[0], r.n) for r in store.load_staging(spark, path, ["k.x"]).drop("batch_id").collect()] == [("a.b", 2)]


def test_additive_store_refuses_overlap(spark):
    import pytest

    path = scratch_path(spark, "t-add")
    day1 = _count(_rows(spark, [(1, "a")]))
    inc.add_disjoint_batch(day1, path)
    inc.add_disjoint_batch(_count(_rows(spark, [(2, "a")])), path)
    with pytest.raises(inc.OverlappingBatchError):
        inc.add_disjoint_batch(day1, path)
    got = sorted((r.day, r.n) for r in inc.read_additive_store(spark, path, keys=("day", "k")).collect())
    assert got == [(D(2024, 1, 1), 1), (D(2024, 1, 2), 1)]


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 300, 70000, 1.5), (2, 5, 1, 2.5)], "a BIGINT, b BIGINT, c BIGINT, d DOUBLE")
    out = store.narrow_types(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["tinyint", "smallint", "int", "float"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 300, 70000, 1.5), (2, 5, 1, 2.5)]


def test_final_overwrite_replaces_everything(spark):
    path = scratch_path(spark, "t-final")
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k STRING, n INT")
    store.save_final(a, path, partition_by=["k"])
    store.save_final(a.where("k = 'x'").withColumn("n", F.lit(5)), path, partition_by=["k"])
    assert sorted((r.k, r.n) for r in spark.read.parquet(path).collect()) == [("x", 5)]
    store.save_final(a.where("k = 'y'"), path, partition_by=["k"], replace_partitions_only=True)
    assert sorted((r.k, r.n) for r in spark.read.parquet(path).collect()) == [("x", 5), ("y", 2)]


def test_max_records_per_file_is_strict(spark):
    import glob

    import pyarrow.parquet as pq

    path = scratch_path(spark, "t-files")
    df = spark.range(10).coalesce(1).withColumn("n", F.col("id"))
    bid = store.append_batch(df, path, max_records_per_file=3)
    files = glob.glob(f"{path}/batch_id={bid}/*.parquet".replace("file:", ""))
    sizes = sorted(pq.ParquetFile(f).metadata.num_rows for f in files)
    assert sum(sizes) == 10 and max(sizes) <= 3 and len(files) == 4


def test_latest_wins_orders_extremes_and_nulls(spark):
    """By hash (numbers only) and by struct (with a text) the same rows win."""
    from pyspark.sql import functions as F

    low, high = -(2**63), 2**63 - 1
    orders = [(None, None), (None, high), (-(2**31), low), (-1, high), (0, None), (0, low), (2**31 - 1, low), (2**31 - 1, high)]
    rows = [(f"k{i % 5}" if i % 5 else None, *orders[(i // 5 + i % 5) % 8], None if i % 7 == 0 else i) for i in range(40)]
    seen = {}
    for k, b, s, n in rows:
        rank = (b is not None, b or 0, s is not None, s or 0)
        assert (k, rank) not in seen
        seen[(k, rank)] = (k, b, s, n)
    want = {k: seen[max(x for x in seen if x[0] == k)] for k in {r[0] for r in rows}}
    df = spark.createDataFrame(rows, "k STRING, b INT, s BIGINT, n INT").repartition(4)
    hashed = latest_wins(df, ["k"], ["b", "s"])
    assert "SortAggregate" not in hashed._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, (tuple(r) for r in hashed.collect()))) == sorted(map(str, want.values()))
    texts = latest_wins(df.withColumn("t", F.lit("x")), ["k"], ["b", "s"]).drop("t")
    assert sorted(map(str, (tuple(r) for r in texts.collect()))) == sorted(map(str, want.values()))

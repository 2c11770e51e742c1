"""Dense matrices in blocks of columns, and filled series kept by month."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daymatrix.operators.timeseries import densify_long, fill_series
from daymatrix.plans import daily, monthly
from daymatrix.session import scratch_path
from daymatrix.sources import blocks, commits
from daymatrix.sources import fixtures as fx

from conftest import SF_SMALL

D = dt.date
LONG = "matrix STRING, day DATE, feature STRING, n BIGINT"


def test_blocks_hold_every_cell(spark):
    rng = random.Random(1)
    names = [f"f.{i}`x" for i in range(130)] + ["a b", "ç", "c0", "timestamp"]
    rows = [(m, D(2024, 1, rng.randrange(1, 28)), rng.choice(names), rng.randrange(-2, 9)) for m in ("RS:1/2", "007", "7") for _ in range(700)]
    rows += [("7", D(2024, 1, 3), "a b", 5), ("7", D(2024, 1, 3), "a b", 6), ("7", None, "a b", 1), ("7", D(2024, 1, 3), None, 1),
             (None, D(2024, 1, 3), "a b", 1), ("7", D(2025, 1, 1), "outside", 1), ("007", D(2024, 1, 2), "nothing", None)]
    ranges = [(D(2024, 1, 1), D(2024, 1, 20)), (D(2024, 1, 15), D(2024, 1, 31)), (D(2024, 3, 1), D(2024, 3, 2))]
    path = blocks.write_blocks(spark.createDataFrame(rows, LONG).repartition(4), ranges, scratch_path(spark, "t-blocks"), width=16)
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(31)] + [D(2024, 3, 1), D(2024, 3, 2)]
    want = {(m, d, f): 0 for m, _, f, _ in rows if m and f for d in days if any(x[1] for x in rows if x[0] == m and x[2] == f)}
    for m, d, f, n in rows:
        if (m, d, f) in want:
            want[m, d, f] += n or 0
    got = blocks.read_long(spark, path, zeros=True).collect()
    assert len(got) == len(want) and {(r.matrix, r.timestamp, r.feature): r.n for r in got} == want
    index = blocks.read_index(spark, path)
    assert index.groupBy("matrix", "block", "position").count().where("count > 1").count() == 0
    assert index.agg(F.max("position")).first()[0] < 16
    some = ["a b", min(f for m, _, f in want if m == "7" and "`" in f)]
    part = {(r.timestamp, f): r[f] for r in blocks.read_columns(spark, path, "7", some).collect() for f in some}
    assert part == {(d, f): want["7", d, f] for d in days for f in some}
    block = index.where("matrix = '7' AND feature = 'a b'").first()["block"]
    assert {(r.timestamp): r["a b"] for r in blocks.read_block(spark, path, "7", block).collect()} == {d: want["7", d, "a b"] for d in days}
    digest = {(r.matrix, r.feature): (r.n_days, r.n_nonzero, r.total) for r in blocks.column_digests(spark, path).collect()}
    assert digest == {(m, f): (33, sum(want[m, d, f] != 0 for d in days), sum(want[m, d, f] for d in days)) for m, f in {(m, f) for m, _, f in want}}
    with pytest.raises(KeyError, match="nope"):
        blocks.read_columns(spark, path, "7", ["nope"])


def test_no_cells_no_blocks(spark):
    path = blocks.write_blocks(spark.createDataFrame([], LONG), [], scratch_path(spark, "t-blocks-empty"))
    assert blocks.read_index(spark, path).count() == 0


def test_one_job_writes_all_blocks(spark):
    """The cells are shuffled once by block; no region or column is in the plan."""
    long = spark.createDataFrame([(f"m{i % 5}", D(2024, 1, 1 + i % 9), f"f{i}", 1) for i in range(400)], LONG)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("t-blocks-jobs", "blocks")
    try:
        blocks.write_blocks(long, [(D(2024, 1, 1), D(2024, 1, 9))], scratch_path(spark, "t-jobs"), width=8)
        few = len(tracker.getJobIdsForGroup("t-blocks-jobs"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert few < 25  # 50 blocks


def test_up_blocks_of_the_final_build(spark):
    out = scratch_path(spark, "t-up-blocks")
    visits, lookup = fx.visits(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL)
    paths = daily.demand_final(spark, visits, lookup, out, up_matrices=True)
    total = blocks.column_digests(spark, paths["demand_up"]).where("feature LIKE 'demanda__TOTAL_UP%'").agg(F.sum("total")).first()[0]
    assert total == visits.count()
    history = daily.historical_blocks(spark, [paths["demand_long"]], f"{out}/history")
    assert {r.matrix for r in blocks.read_index(spark, history).select("matrix").distinct().collect()} == {"demand_cat", "demand_rs", "demand_up"}
    with pytest.raises(daily.MissingInputError):
        daily.historical_blocks(spark, [paths["demand_long"], f"{out}/nope"], f"{out}/h2")


# --- filled series by month -------------------------------------------------------

CELLS = "feature STRING, day DATE, n BIGINT"


def _full(df):
    return sorted(map(tuple, fill_series(densify_long(df.where("n IS NOT NULL"), ["feature"], "day", "n", fill=None), ["feature"]).select("feature", "day", "n").collect()))


def _got(spark, path):
    return sorted(map(tuple, monthly.read_filled(spark, path).collect()))


def _cells(spark, rows):
    return spark.createDataFrame([(f, D(2024, 1, 1) + dt.timedelta(days=d), n) for f, d, n in rows], CELLS)


def test_months_equal_the_full_build(spark):
    path = scratch_path(spark, "t-months")
    rows = [("a", 3, 1), ("a", 40, 2), ("a", 70, 3), ("b", 10, 5), ("b", 75, 6), ("late", 65, 9), ("null", 66, None)]
    assert monthly.update(_cells(spark, rows), path) == [D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1)]
    assert _got(spark, path) == _full(_cells(spark, rows))
    # A changed day whose month ends as before: later months stand.
    rows[1] = ("a", 40, 7)
    rows.insert(2, ("a", 50, 2))
    assert monthly.update(_cells(spark, rows), path, D(2024, 2, 1), D(2024, 2, 29)) == [D(2024, 2, 1)]
    assert _got(spark, path) == _full(_cells(spark, rows))
    # One that ends otherwise: they are redone.
    rows[2] = ("a", 50, 11)
    assert monthly.update(_cells(spark, rows), path, D(2024, 2, 20), D(2024, 2, 20))[-1] == D(2024, 3, 1)
    assert _got(spark, path) == _full(_cells(spark, rows))
    # New days, a new feature in an old month, and one that goes.
    rows = [r for r in rows if r[0] != "late"] + [("new", 45, 4), ("b", 130, 1)]
    assert monthly.update(_cells(spark, rows), path, D(2024, 2, 1))[0] == D(2024, 2, 1)
    assert _got(spark, path) == _full(_cells(spark, rows))
    # An earlier first day, and fewer days at the end.
    rows = [("a", -20, 8)] + [r for r in rows if r[1] < 100]
    monthly.update(_cells(spark, rows), path, D(2024, 5, 1))
    assert _got(spark, path) == _full(_cells(spark, rows))
    assert monthly.vacuum(spark, path) and _got(spark, path) == _full(_cells(spark, rows))
    assert monthly.update(_cells(spark, rows).where("false"), path) == [] and _got(spark, path) == []


def test_random_runs_equal_the_full_build(spark):
    rng = random.Random(4)
    path, rows, until = scratch_path(spark, "t-months-random"), {}, 50
    for _ in range(5):
        touched = [(rng.choice("abcdef"), rng.randrange(max(0, until - 45), until)) for _ in range(12)]
        for key in touched:
            rows[key] = rng.randrange(5)
        for key in rng.sample(sorted(rows), min(2, len(rows))):
            touched.append(key)
            del rows[key]
        first = D(2024, 1, 1) + dt.timedelta(days=min(d for _, d in touched))
        df = _cells(spark, [(f, d, n) for (f, d), n in rows.items()])
        monthly.update(df, path, first)
        assert _got(spark, path) == _full(df)
        until += 25


def test_interrupted_month_run(spark, monkeypatch):
    path = scratch_path(spark, "t-months-lost")
    one, two = _cells(spark, [("a", 1, 1), ("a", 20, 2)]), _cells(spark, [("a", 1, 1), ("a", 20, 3), ("a", 45, 4)])
    monthly.update(one, path)
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            monthly.update(two, path, D(2024, 1, 20))
    assert _got(spark, path) == _full(one)
    monthly.update(two, path, D(2024, 1, 20))
    assert _got(spark, path) == _full(two)

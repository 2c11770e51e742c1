"""Blocks of dense matrices: files, shares."""
import datetime as dt

from pyspark.sql import functions as F

from daymatrix.session import scratch_path
from daymatrix.sources import blocks, commits

D = dt.date
LONG = "matrix STRING, day DATE, feature STRING, n BIGINT"


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


def test_files_follow_the_cells_and_not_the_blocks(spark):
    """Many blocks of few cells come in few files, each whole block in one."""
    rows = [(f"m{i % 2}", D(2024, 1, 1 + i % 9), f"f{i}", i) for i in range(900)]
    path = blocks.write_blocks(spark.createDataFrame(rows, LONG), [(D(2024, 1, 1), D(2024, 1, 9))], scratch_path(spark, "t-few-files"), width=4)
    index = blocks.read_index(spark, path)
    n = index.select("matrix", "block").distinct().count()
    assert n >= 225 and len(_files(spark, f"{path}/cells")) <= n // 8
    cells = spark.read.parquet(f"{path}/cells")
    assert cells.count() == n * 9
    assert cells.select("matrix", "block", F.input_file_name().alias("f")).distinct().count() == n
    got = {(r.matrix, r.timestamp, r.feature): r.n for r in blocks.read_long(spark, path).collect()}
    assert got == {(m, d, f): v for m, d, f, v in rows if v}


def test_shares_of_blocks_seldom_overflow(spark):
    rows = [("m", D(2024, 1, 1), f"f{i}", 1) for i in range(5000)]
    index = blocks.block_index(spark.createDataFrame(rows, LONG).select("matrix", "feature"), width=100)
    assert index.agg(F.max("position")).first()[0] < 100 and index.count() == 5000
    assert index.select("block").distinct().count() <= 75   # 50 is the least


def test_a_row_of_cells_is_one_value_of_every_number(spark):
    """Each day is a row of 8 bytes a column, zeros and negative numbers included."""
    n = [0, 1, -1, 2**63 - 1, -2**63, 255, -256, 1 << 40]
    rows = [("m", D(2024, 1, 1 + i % 3), f"f{i}", v) for i, v in enumerate(n)] + [("z", D(2024, 1, 2), "only", 0)]
    path = blocks.write_blocks(spark.createDataFrame(rows, LONG), [(D(2024, 1, 1), D(2024, 1, 4))], scratch_path(spark, "t-packed"))
    stored = spark.read.parquet(f"{path}/cells")
    assert stored.columns == ["matrix", "block", "timestamp", "cells"]
    assert {(r.matrix, r.n, r.days) for r in stored.groupBy("matrix", F.octet_length("cells").alias("n")).agg(F.count("*").alias("days")).collect()} == \
        {("m", 64, 4), ("z", 8, 4)}
    want = {(f"f{i}", D(2024, 1, d)): v if d == 1 + i % 3 else 0 for i, v in enumerate(n) for d in range(1, 5)}
    block = blocks.read_block(spark, path, "m", 0).collect()
    assert {(f"f{i}", r.timestamp): r[f"f{i}"] for r in block for i in range(len(n))} == want
    names = {r.position: r.feature for r in blocks.read_index(spark, path).where("matrix = 'm'").collect()}
    arrays = blocks.read_rows(spark, path).where("matrix = 'm'").collect()
    assert {(names[i], r.timestamp): v for r in arrays for i, v in enumerate(r.cells)} == want


def test_names_are_placed_as_the_index_places_them(spark):
    """No join gives a cell its position: shares past the width, names of any
    bytes, and features that have no day inside the calendar."""
    names = [f"{c}{i}" for c in ("a", "Z", "ç", "日本", "\U0001f600", "￮", "é", "é") for i in range(40)]
    rows = [(m, D(2024, 1, 1 + i % 5), f, i + 1) for m in ("p", "q") for i, f in enumerate(names)]
    rows += [("p", D(2030, 1, 1), f"out{i}", 9) for i in range(30)] + [("q", D(2024, 1, 1), names[0], 5)]
    path = blocks.write_blocks(spark.createDataFrame(rows, LONG).repartition(3), [(D(2024, 1, 1), D(2024, 1, 5))], scratch_path(spark, "t-place"), width=3)
    index = blocks.read_index(spark, path)
    assert index.count() == 2 * len(names) + 30 and index.agg(F.max("position")).first()[0] == 2
    want = {}
    for m, d, f, n in rows:
        if d.year == 2024:
            want[m, d, f] = want.get((m, d, f), 0) + n
    assert {(r.matrix, r.timestamp, r.feature): r.n for r in blocks.read_long(spark, path).collect()} == want
    out = blocks.column_digests(spark, path).where("feature LIKE 'out%'").collect()
    assert len(out) == 30 and {(r.n_days, r.n_nonzero, r.total, r.weighted) for r in out} == {(5, 0, 0, 0)}


def test_cells_move_once(spark, monkeypatch):
    """Between the written cells and the blocks there is one shuffle and no join of names."""
    seen = []
    real = blocks._dense
    monkeypatch.setattr(blocks, "_dense", lambda cells, days, width: seen.append(real(cells, days, width)) or seen[0])
    rows = [(f"m{i % 3}", D(2024, 1, 1 + i % 9), f"f{i}", 1) for i in range(300)]
    blocks.write_blocks(spark.createDataFrame(rows, LONG), [(D(2024, 1, 1), D(2024, 1, 9))], scratch_path(spark, "t-once"), width=8)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_digests_of_no_blocks(spark):
    path = blocks.write_blocks(spark.createDataFrame([], LONG), [], scratch_path(spark, "t-none"))
    assert blocks.column_digests(spark, path).count() == 0 and blocks.read_long(spark, path, zeros=True).count() == 0
    path = blocks.write_blocks(spark.createDataFrame([("m", D(2024, 1, 1), "f", 1)], LONG), [], scratch_path(spark, "t-no-days"))
    assert blocks.read_index(spark, path).count() == 1 and blocks.read_long(spark, path).count() == 0


def test_sums_past_64_bits_are_errors():
    import numpy as np
    import pytest

    grid = np.zeros((2, 2), dtype=np.int64)
    big = np.array([2**62, 2**62, -5])
    with pytest.raises(OverflowError):
        blocks._add(grid, np.array([0, 0, 1]), np.array([1, 1, 0]), big)
    blocks._add(grid, np.array([0, 1, 1]), np.array([1, 1, 0]), big)
    assert grid.tolist() == [[0, 2**62], [-5, 2**62]]

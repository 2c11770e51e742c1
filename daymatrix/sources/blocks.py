"""Zero-filled dense matrices of any number of columns, in one job.

A matrix is a set of blocks of up to ``width`` columns over the same days. Which
feature is which column of which block is a table, the block index
``(matrix, block, position, feature)``; the blocks themselves are rows
``matrix, block, timestamp, cells``: ``cells`` holds the number of every column, by
position and zeros included, in 8 bytes each (signed, most significant byte first).
So all blocks of all matrices have one schema and are written by one job, and neither
the driver nor a plan ever holds the names: only a reader of a single block turns its
positions into names. ``cell`` is the number at one position as an expression,
``read_rows`` gives the rows with arrays of numbers.

* Features are dealt to blocks by hash, numbered in order within their share of a
  block, and go on into further blocks where a share is larger than ``width``. Shares
  are filled a little below ``width`` on average, so that few of them need a second one.
* Cells are shuffled once, by runs of ``RUN`` shares, with all cells of a share in one
  group. The names of a group are the names of its share in the index, so their order
  gives each cell the position that the index gives its feature, without a join. Only
  the cells that have a count move, never the zeros: a task turns the cells of one
  share into its days times its columns and writes them in that order, so nothing wide
  is sorted, shuffled or held for more than one share.
* Every day of the calendar, given as ranges, is a row of every block, also of
  one without any count.
* Files hold whole blocks, in order, with ``matrix`` and ``block`` as columns: the
  number of files follows the cells, and a reader of few blocks skips the rest by
  the bounds in the files.
* A row of numbers is one value and not ``width`` columns or an array, since Spark
  handles each number of those by itself, several times as long as the number's
  whole way takes here. The zeros are written as they are and left to compression
  (``FILES``).

Defined cases: duplicate cells are summed; rows with a null matrix, day or feature
are left out; days outside the calendar are left out; without cells there are no
blocks.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daymatrix.session import written

WIDTH = 250
RUN = 32   # consecutive shares of a matrix that one task lays out
MATRIX, BLOCK, POSITION, FEATURE, CELLS = "matrix", "block", "position", "feature", "cells"
# Rows of numbers seldom repeat, and their least and greatest tell nothing.
FILES = {"compression": "zstd", f"parquet.enable.dictionary#{CELLS}": "false", f"parquet.column.statistics.enabled#{CELLS}": "false"}
ROWS = 10_000   # rows of a batch that a task hands over


def _shares(features: DataFrame, width: int) -> DataFrame:
    """``matrix, shares`` of distinct ``(matrix, feature)`` rows: the hash shares
    that each matrix is dealt to. Written, so that joins know how small it is."""
    usual = max(1, int(width - 2.5 * math.sqrt(width)))   # a hash share of this mean seldom passes ``width``
    n = F.count("*")
    return written(features.groupBy(MATRIX).agg(F.when(n <= width, 1).otherwise(F.ceil(n / usual)).cast("int").alias("shares")), "shares")


def _deal(df: DataFrame, shares: DataFrame) -> DataFrame:
    # A matrix has few rows in ``shares`` and many in ``df``: the side with one row a matrix is read by all.
    return df.join(shares, MATRIX).withColumn("share", F.pmod(F.xxhash64(FEATURE), F.col("shares")).cast("int"))


def block_index(features: DataFrame, width: int = WIDTH, shares: DataFrame | None = None) -> DataFrame:
    """``matrix, block, position, feature`` for distinct ``(matrix, feature)``
    rows. Each matrix has as many hash shares as blocks it needs; a share is
    numbered by itself, in the order of its features' bytes."""
    dealt = _deal(features, shares if shares is not None else _shares(features, width))
    place = F.row_number().over(Window.partitionBy(MATRIX, "share").orderBy(FEATURE)) - 1
    return dealt.withColumn("place", place).select(
        MATRIX, (F.col("share") + F.col("shares") * F.floor(F.col("place") / width)).cast("int").alias(BLOCK),
        (F.col("place") % width).cast("int").alias(POSITION), FEATURE)


def _calendar(ranges: Sequence[tuple[dt.date, dt.date]]) -> list[dt.date]:
    days = {lo + dt.timedelta(days=i) for lo, hi in ranges for i in range((hi - lo).days + 1)}
    return sorted(days)


def _dense(cells: DataFrame, days: list[dt.date], width: int) -> DataFrame:
    """The rows of all blocks of dealt ``cells``: ``matrix, block, timestamp, cells``.
    Features are placed as ``block_index`` places them; a cell without a day only
    names its feature."""
    dates = np.array(days, dtype="datetime64[D]")
    stamps = pa.array(dates, pa.date32())
    none = pa.schema([(MATRIX, pa.string()), (BLOCK, pa.int32()), ("timestamp", pa.date32()), (CELLS, pa.binary())]).empty_table()

    def rows_of(matrix: str, block: int, grid: np.ndarray) -> Iterator[pa.Table]:
        for first in range(0, len(dates), ROWS):
            packed = grid[first:first + ROWS].astype(">i8")
            ends = np.arange(len(packed) + 1, dtype=np.int32) * packed[0].nbytes
            cells = pa.Array.from_buffers(pa.binary(), len(packed), [None, pa.py_buffer(ends), pa.py_buffer(packed)])
            yield pa.Table.from_arrays([pa.repeat(pa.scalar(matrix), len(packed)), pa.repeat(pa.scalar(block, pa.int32()), len(packed)),
                                        stamps[first:first + ROWS], cells], names=[MATRIX, BLOCK, "timestamp", CELLS])

    def lay_out(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        coded = rows[FEATURE].combine_chunks().dictionary_encode()
        place = np.empty(len(coded.dictionary), dtype=np.int64)
        place[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(place))
        counted = rows["day"].is_valid().to_numpy() & rows["n"].is_valid().to_numpy()
        column = place[coded.indices.to_numpy()[counted]]
        at = np.searchsorted(dates, rows["day"].to_numpy()[counted].astype("datetime64[D]"))
        n = rows["n"].fill_null(0).to_numpy()[counted]
        matrix, _, share, shares = (k.as_py() for k in key)
        out = [none]
        for k, first in enumerate(range(0, len(place), width)):
            grid = np.zeros((len(dates), min(width, len(place) - first)), dtype=np.int64)
            here = (column >= first) & (column < first + width)
            _add(grid, at[here], column[here] - first, n[here])
            out += rows_of(matrix, share + shares * k, grid)
        return pa.concat_tables(out)

    schema = T.StructType([T.StructField(MATRIX, T.StringType(), False), T.StructField(BLOCK, T.IntegerType(), False),
                           T.StructField("timestamp", T.DateType(), False), T.StructField(CELLS, T.BinaryType(), False)])
    return cells.groupBy(MATRIX, "run", "share", "shares").applyInArrow(lay_out, schema)


def _add(grid: np.ndarray, row: np.ndarray, column: np.ndarray, n: np.ndarray) -> None:
    """Add ``n`` to the cells of ``grid``; a sum past 64 bits is an error, as in Spark's sums."""
    if np.abs(n.astype(float)).sum() >= 2.0**62:
        sums: dict[tuple[int, int], int] = {}
        for key, v in zip(zip(row.tolist(), column.tolist()), n.tolist()):
            sums[key] = sums.get(key, 0) + v
        if any(not -2**63 <= v < 2**63 for v in sums.values()):
            raise OverflowError("a cell of a matrix has a sum past 64 bits")
    np.add.at(grid, (row, column), n)


def write_blocks(long: DataFrame, ranges: Sequence[tuple[dt.date, dt.date]], path: str, width: int = WIDTH) -> str:
    """Write ``long`` (``matrix, day, feature, n``) as blocks over the days of
    ``ranges`` (first and last day each; they may overlap). ``<path>/index`` is
    the block index, ``<path>/cells`` the blocks. Returns ``path``."""
    spark = long.sparkSession
    inside = F.lit(False)
    for lo, hi in ranges:
        inside = inside | F.col("day").between(F.lit(lo), F.lit(hi))
    cells = written(long.where(f"{MATRIX} IS NOT NULL AND day IS NOT NULL AND feature IS NOT NULL")
                    .select(MATRIX, "day", FEATURE, F.col("n").cast("long").alias("n")), "cells")
    features = written(cells.select(MATRIX, FEATURE).distinct(), "features")
    shares = _shares(features, width)
    block_index(features, width, shares).write.mode("overwrite").parquet(f"{path}/index")
    run = F.floor(F.col("share") / RUN).cast("int")
    # A number of its own: the sparse cells are small, what a task writes of them is not.
    runs = shares.agg(F.sum(F.ceil(F.col("shares") / RUN))).first()[0] or 1
    dealt = (
        _deal(cells.withColumn("day", F.when(inside, F.col("day"))), shares)
        .select(MATRIX, run.alias("run"), "share", "shares", FEATURE, "day", "n")
        .repartition(int(runs), MATRIX, "run")
    )
    _dense(dealt, _calendar(ranges), width).write.mode("overwrite").options(**FILES).parquet(f"{path}/cells")
    return path


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def _cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/cells")


def cell(position: int) -> Column:
    """The number at a position of ``cells``."""
    return F.conv(F.hex(F.substring(CELLS, 8 * position + 1, 8)), 16, -10).cast("long")


def _numbers(cells: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the rows in a sequence, and where in it each row begins."""
    ends = np.frombuffer(cells.buffers()[1], dtype=np.int32)[cells.offset:cells.offset + len(cells) + 1]
    data = cells.buffers()[2]
    return np.frombuffer(data if data is not None else b"", dtype=np.uint8)[ends[0]:ends[-1]].view(">i8"), (ends - ends[0]) // 8


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """``matrix, block, timestamp, cells`` of all blocks, ``cells`` as an array of numbers by position."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, starts = _numbers(b.column(CELLS))
            arrays = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*b.select([MATRIX, BLOCK, "timestamp"]).columns, arrays], names=[MATRIX, BLOCK, "timestamp", CELLS])

    rows = _cells(spark, path).select(MATRIX, BLOCK, "timestamp", CELLS)
    return rows.mapInArrow(unpack, f"{MATRIX} STRING, {BLOCK} INT, timestamp DATE, {CELLS} ARRAY<BIGINT>")


def _counted(cells: DataFrame) -> DataFrame:
    """``matrix, block, timestamp, counted`` of the rows that have a cell that is
    not 0: ``counted`` is an array of those cells' ``position, n``."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, starts = _numbers(b.column(CELLS))
            at = np.flatnonzero(flat.view(np.int64))   # 0 is 0 in either order of bytes
            row = np.searchsorted(starts, at, side="right") - 1
            some, firsts = np.unique(row, return_index=True)
            pairs = pa.StructArray.from_arrays([pa.array((at - starts[row]).astype(np.int32)), pa.array(flat[at].astype(np.int64))], [POSITION, "n"])
            counted = pa.ListArray.from_arrays(pa.array(np.append(firsts, len(at)).astype(np.int32)), pairs)
            fixed = b.select([MATRIX, BLOCK, "timestamp"]).take(pa.array(some))
            yield pa.RecordBatch.from_arrays([*fixed.columns, counted], names=[MATRIX, BLOCK, "timestamp", "counted"])

    rows = cells.select(MATRIX, BLOCK, "timestamp", CELLS)
    return rows.mapInArrow(found, f"{MATRIX} STRING, {BLOCK} INT, timestamp DATE, counted ARRAY<STRUCT<{POSITION}: INT, n: BIGINT>>")


def read_block(spark: SparkSession, path: str, matrix: str, block: int) -> DataFrame:
    """One block under its own column names: ``timestamp`` and its features."""
    names = {r[POSITION]: r[FEATURE] for r in read_index(spark, path).where((F.col(MATRIX) == matrix) & (F.col(BLOCK) == block)).collect()}
    rows = _cells(spark, path).where((F.col(MATRIX) == matrix) & (F.col(BLOCK) == block))
    return rows.select("timestamp", *(cell(i).alias(names[i]) for i in sorted(names)))


def read_columns(spark: SparkSession, path: str, matrix: str, features: Sequence[str]) -> DataFrame:
    """Some columns of a matrix by name; only their blocks are read."""
    at = {r[FEATURE]: (r[BLOCK], r[POSITION]) for r in read_index(spark, path).where((F.col(MATRIX) == matrix) & F.col(FEATURE).isin(list(features))).collect()}
    if missing := [f for f in features if f not in at]:
        raise KeyError(f"not in {matrix}: {missing[:10]}")
    rows = _cells(spark, path).where(F.col(MATRIX) == matrix)
    picked = [F.max(F.when(F.col(BLOCK) == at[f][0], cell(at[f][1]))).alias(f) for f in features]
    blocks = sorted({b for b, _ in at.values()})
    return rows.where(F.col(BLOCK).isin(blocks)).groupBy("timestamp").agg(*picked)


def read_long(spark: SparkSession, path: str, zeros: bool = False) -> DataFrame:
    """``matrix, timestamp, feature, n`` of all blocks; cells of 0 only if asked for."""
    # Rows meet the names of their block, in order of position, before they are taken apart.
    named = F.sort_array(F.collect_list(F.struct(POSITION, FEATURE)))
    names = read_index(spark, path).groupBy(MATRIX, BLOCK).agg(named[FEATURE].alias("names"))
    if zeros:
        each = read_rows(spark, path).join(names, [MATRIX, BLOCK]).select(MATRIX, "timestamp", "names", F.posexplode(CELLS).alias(POSITION, "n"))
    else:
        each = _counted(_cells(spark, path)).join(names, [MATRIX, BLOCK]).select(MATRIX, "timestamp", "names", F.inline("counted"))
    return each.select(MATRIX, "timestamp", F.get("names", POSITION).alias(FEATURE), "n")


def column_digests(spark: SparkSession, path: str) -> DataFrame:
    """For every column: its days, its cells that are not 0, their sum, and the
    sum weighted by the day's number in the calendar, from the stored blocks."""
    cells = _cells(spark, path)
    # Written, so that the join below knows how small they are: a row a block.
    days = written(cells.groupBy(MATRIX, BLOCK).agg(F.count("*").alias("n_days"), F.min("timestamp").alias("first")), "block-days")
    start = F.lit(days.agg(F.min("first")).first()[0])
    # Weighted by the days from the first of all blocks on, added up by position, so
    # that only one row a column meets its block's days and its name.
    sums = _counted(cells).select(MATRIX, BLOCK, "timestamp", F.inline("counted")).groupBy(MATRIX, BLOCK, POSITION).agg(
        F.count("*").alias("n_nonzero"), F.sum("n").alias("total"), F.sum(F.col("n") * (F.datediff("timestamp", start) + 1)).alias("weighted"))
    zero = F.lit(0).cast("long")
    return read_index(spark, path).join(sums, [MATRIX, BLOCK, POSITION], "left").join(days, [MATRIX, BLOCK]).select(
        MATRIX, FEATURE, "n_days", F.coalesce("n_nonzero", zero).alias("n_nonzero"), F.coalesce("total", zero).alias("total"),
        F.coalesce(F.col("weighted") - F.col("total") * F.datediff("first", start), zero).alias("weighted"))

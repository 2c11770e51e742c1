"""Bounded scans of a source table.

Filters compare the raw date column with a literal of its own type, so they
reach the Parquet scan (or a JDBC query) as pushed predicates; the column
list becomes the read schema. No ordering is requested at scan time (O2):
order is irrelevant before aggregation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lit_like(df: DataFrame, col: str, value):
    return F.lit(value).cast(df.schema[col].dataType)


def scan_range(df: DataFrame, date_col: str, lo, hi, columns: Sequence[str] | None = None,
               after=None) -> DataFrame:
    """Rows with ``lo <= date < hi`` (S1), and ``date > after`` when given."""
    cond = (F.col(date_col) >= _lit_like(df, date_col, lo)) & (F.col(date_col) < _lit_like(df, date_col, hi))
    if after is not None:
        cond = cond & (F.col(date_col) > _lit_like(df, date_col, after))
    out = df.where(cond)
    return out.select(*columns) if columns else out


def scan_not_null(df: DataFrame, date_col: str, lo, hi, required: str, after=None,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """S1/S2 plus ``required IS NOT NULL`` (S3)."""
    return scan_range(df.where(F.col(required).isNotNull()), date_col, lo, hi, columns, after)


def date_bounds(df: DataFrame, date_col: str, min_valid=None, as_of=None) -> DataFrame:
    """One row ``min_date, max_date`` over non-null dates ``>= min_valid``; the
    max is capped at ``as_of`` (S4, F5, X13)."""
    rows = df.where(F.col(date_col).isNotNull())
    if min_valid is not None:
        rows = rows.where(F.col(date_col) >= _lit_like(df, date_col, min_valid))
    if as_of is not None:
        rows = rows.where(F.col(date_col) < _lit_like(df, date_col, _next_day(as_of)))
    return rows.agg(F.to_date(F.min(date_col)).alias("min_date"), F.to_date(F.max(date_col)).alias("max_date"))


def statistics_frame(spark: SparkSession, path: str, date_col: str) -> DataFrame:
    """One row ``min_date, max_date, n_rows`` of a stored table's DATE column, read
    from the Parquet footers: the aggregates are pushed into the scan, no page is
    read. The settings this takes live in a session of their own, so ``spark`` keeps
    its own; the frame cannot be joined with frames of ``spark``."""
    aside = spark.newSession()
    aside.conf.set("spark.sql.sources.useV1SourceList", "")
    aside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return aside.read.parquet(path).agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                                        F.count(F.lit(1)).alias("n_rows"))


def stored_bounds(spark: SparkSession, path: str, date_col: str, min_valid=None, as_of=None) -> DataFrame:
    """:func:`date_bounds` of a stored table. Footers answer it for a DATE column
    whose dates all lie within the limits; footers hold no statistics of other
    types that Spark pushes down, and a limit that cuts rows off needs the rows,
    so both are scanned."""
    df = spark.read.parquet(path)
    if df.schema[date_col].dataType == T.DateType():
        try:
            lo, hi, _ = statistics_frame(spark, path, date_col).first()
        except Exception as e:  # a row group without any date has no statistics
            if "No min/max found" not in str(e):
                raise
            return date_bounds(df, date_col, min_valid, as_of)
        low = min_valid is None or lo is None or lo >= _day(min_valid)
        high = as_of is None or hi is None or hi <= _day(as_of)
        if low and high:
            return spark.range(1).select(F.lit(lo).cast("date").alias("min_date"), F.lit(hi).cast("date").alias("max_date"))
    return date_bounds(df, date_col, min_valid, as_of)


def _day(d) -> dt.date:
    return _next_day(d) - dt.timedelta(days=1)


def _next_day(d) -> dt.date:
    if isinstance(d, dt.datetime):
        d = d.date()
    if not isinstance(d, dt.date):
        d = dt.date.fromisoformat(str(d)[:10])
    return d + dt.timedelta(days=1)

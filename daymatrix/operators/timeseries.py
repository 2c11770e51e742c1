"""Calendars, densify and fills.

Fills run in long form, one window partition per feature, so they spread
over the cluster; a fill over a wide frame would need a window without
``partitionBy`` and move every row to one task. Densify emits exactly the
output rows: each feature generates its own calendar with ``sequence``, and
the sparse counts are merged in by a union + aggregation (null-safe on every
key, no join, one shuffle).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymatrix.session import materialize
from daymatrix.functions.names import qcol

FILL_METHODS = ("ffill", "bfill", "interpolate", None)


def bounds(df: DataFrame, day_col: str = "day") -> tuple[dt.date | None, dt.date | None]:
    """``(min, max)`` of a day column: two scalars to the driver."""
    row = df.agg(F.min(day_col).alias("lo"), F.max(day_col).alias("hi")).collect()[0]
    return (row["lo"], row["hi"]) if row is not None else (None, None)


def _as_date(d) -> dt.date | None:
    if d is None:
        return None
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d)[:10])


def day_sequence(start: Column, end: Column) -> Column:
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))


def calendar(spark: SparkSession, start, end, name: str = "day") -> DataFrame:
    """Continuous daily calendar ``[start, end]`` (M9)."""
    return spark.range(1).select(
        F.explode(day_sequence(F.lit(_as_date(start)), F.lit(_as_date(end)))).alias(name)
    )


def year_ranges(df: DataFrame, day_col: str = "day") -> DataFrame:
    """``(year, year_start, year_end)`` with ``[Jan 1 y, Jan 1 y+1)`` for every
    year between the bounds of ``day_col`` (T2), computed without the driver."""
    years = df.agg(F.year(F.min(day_col)).alias("lo"), F.year(F.max(day_col)).alias("hi")) \
        .where(F.col("lo").isNotNull()) \
        .select(F.explode(F.sequence("lo", "hi")).alias("year"))
    return years.select(
        "year",
        F.make_date("year", F.lit(1), F.lit(1)).alias("year_start"),
        F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)).alias("year_end"),
    )


def densify_long(long: DataFrame, keys: Sequence[str], day_col: str = "day", value_col: str = "n",
                 start=None, end=None, fill: int | float | None = 0) -> DataFrame:
    """Every feature (``keys``) on every day of ``[start, end]``.

    Defaults to the global min/max of ``day_col``; rows outside the range are
    dropped; missing cells -> ``fill`` (``None`` keeps them null); empty
    input gives empty output.
    """
    lo, hi = (start, end)
    if lo is None or hi is None:
        long = materialize(long)
        b_lo, b_hi = bounds(long, day_col)
        lo = lo if lo is not None else b_lo
        hi = hi if hi is not None else b_hi
    if lo is None or hi is None:
        return long.select(*keys, day_col, value_col).where(F.lit(False))
    lo, hi = _as_date(lo), _as_date(hi)
    sparse = long.where(F.col(day_col).between(F.lit(lo), F.lit(hi))).select(*keys, day_col, value_col)
    grid = (
        long.select(*keys).distinct()
        .select(*keys, F.explode(day_sequence(F.lit(lo), F.lit(hi))).alias(day_col),
                F.lit(None).cast(sparse.schema[value_col].dataType).alias(value_col))
    )
    # Partitioned by the feature keys: the merge below and any per-feature
    # window after it (fills) share this one shuffle.
    merged = sparse.unionByName(grid).repartition(*keys).groupBy(*keys, day_col).agg(
        F.sum(value_col).alias(value_col))
    if fill is not None:
        merged = merged.withColumn(value_col, F.coalesce(F.col(value_col), F.lit(fill)))
    return merged


def densify_wide(wide: DataFrame, key: str = "timestamp", start=None, end=None,
                 fill: int | float = 0) -> DataFrame:
    """Wide matrix on a continuous daily index (T1): the calendar joined with
    the matrix, one row per day each; Spark broadcasts the matrix if it turns
    out small."""
    lo, hi = start, end
    if lo is None or hi is None:
        wide = materialize(wide)
        b_lo, b_hi = bounds(wide, key)
        lo = lo if lo is not None else b_lo
        hi = hi if hi is not None else b_hi
    if lo is None or hi is None:
        return wide.where(F.lit(False))
    cal = calendar(wide.sparkSession, lo, hi, key)
    cols = [c for c in wide.columns if c != key]
    out = cal.join(wide, key, "left")
    return out.select(key, *[F.coalesce(qcol(c), F.lit(fill)).alias(c) for c in cols])


def fill_series(long: DataFrame, keys: Sequence[str], day_col: str = "day", value_col: str = "n",
                method: str | None = "ffill", zero_fill: bool = True) -> DataFrame:
    """Fill nulls along each feature's day order.

    ``ffill``: last non-null so far; ``bfill``: next non-null; ``interpolate``:
    linear by row position between the surrounding non-nulls, trailing nulls
    take the last value, leading nulls stay; ``None``: no fill. Then the
    residual nulls become 0 when ``zero_fill`` (the reference always does).

    Every window frame grows from the partition start to the current row,
    which Spark evaluates incrementally (O(n) per feature). "Next non-null"
    is the same frame over the descending day order: a frame running to the
    partition end would be re-evaluated for every row (O(n^2) per feature).
    """
    if method not in FILL_METHODS:
        raise ValueError(f"unknown fill method {method!r}")
    asc = Window.partitionBy(*keys).orderBy(F.col(day_col).asc())
    desc = Window.partitionBy(*keys).orderBy(F.col(day_col).desc())
    so_far = asc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_end = desc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v = F.col(value_col)
    if method == "ffill":
        filled = F.last(v, ignorenulls=True).over(so_far)
    elif method == "bfill":
        filled = F.last(v, ignorenulls=True).over(from_end)
    elif method == "interpolate":
        out = long.withColumn("__pos", F.row_number().over(asc))
        known_pos = F.when(v.isNotNull(), F.col("__pos"))
        out = out.select(
            "*",
            F.last(v, ignorenulls=True).over(so_far).cast("double").alias("__pv"),
            F.last(known_pos, ignorenulls=True).over(so_far).alias("__pp"),
            F.last(v, ignorenulls=True).over(from_end).cast("double").alias("__nv"),
            F.last(known_pos, ignorenulls=True).over(from_end).alias("__np"),
        )
        slope = (F.col("__nv") - F.col("__pv")) / (F.col("__np") - F.col("__pp")).cast("double")
        interp = (
            F.when(v.isNotNull(), v.cast("double"))
            .when(F.col("__pv").isNull(), F.lit(None).cast("double"))
            .when(F.col("__nv").isNull(), F.col("__pv"))
            .otherwise(slope * (F.col("__pos") - F.col("__pp")).cast("double") + F.col("__pv"))
        )
        out = out.withColumn(value_col, interp).drop("__pos", "__pv", "__pp", "__nv", "__np")
        return out.withColumn(value_col, F.coalesce(v, F.lit(0.0))) if zero_fill else out
    else:
        filled = v
    out = long.withColumn(value_col, filled)
    return out.withColumn(value_col, F.coalesce(F.col(value_col), F.lit(0))) if zero_fill else out

"""Reports over finished counts and matrices."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.operators.reshape import to_wide


def total_by_group(reduced: DataFrame, group: str = "RS", day_col: str = "DATA_VISITA",
                   features: Sequence[str] | None = None, prefix: str = "DIAG_TOTAL") -> DataFrame:
    """Daily totals with one column per group, ``<prefix>__<group>__<value>``."""
    long = reduced.groupBy(day_col, group).agg(F.sum("n").alias("n")).select(
        day_col, F.concat(F.lit(f"{prefix}__{group}__"), group).alias("feature"), "n")
    return to_wide(long, key=day_col, features=features)


def selected_matrix(counts: DataFrame, scope: str, features: Sequence[str] | None = None) -> DataFrame:
    """Wide matrix of the selected 3-character codes at one scope."""
    rows = counts.where((F.col("scope") == scope) & (F.col("variable") == "ICD10_3"))
    name = F.concat(F.lit("ICD10_3__"), "value")
    if scope != "CAT":
        name = F.concat(name, F.lit(f"__{scope}__"), "group_value")
    return to_wide(rows.select("day", name.alias("feature"), "n"), features=features)


def last_valid_date(frames: Sequence[DataFrame], lo: dt.date, hi: dt.date, day_col: str = "timestamp") -> DataFrame:
    """One row ``last_date``: the greatest day of any frame within the sanity
    window ``[lo, hi]`` (A14, F6)."""
    days = reduce(DataFrame.unionByName, [f.select(day_col) for f in frames])
    return days.where(F.col(day_col).between(F.lit(lo), F.lit(hi))).agg(F.max(day_col).alias("last_date"))


def recent(long: DataFrame, since: dt.date, features: Sequence[str]) -> DataFrame:
    """Wide matrix of some features from a day on."""
    rows = long.where((F.col("day") >= F.lit(since)) & F.col("feature").isin(list(features)))
    return to_wide(rows, features=features)


def monthly_totals(long: DataFrame) -> DataFrame:
    """``month, feature, n``."""
    return long.groupBy(F.trunc("day", "MM").alias("month"), "feature").agg(F.sum("n").cast("long").alias("n"))


def range_totals(long: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """``feature, n`` summed over the days ``[lo, hi]``."""
    return (long.where(F.col("day").between(F.lit(lo), F.lit(hi)))
            .groupBy("feature").agg(F.sum("n").cast("long").alias("n")))

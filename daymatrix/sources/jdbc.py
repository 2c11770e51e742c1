"""Database sources read in parallel by month (S1, S2, T2 over JDBC).

Each month of the asked range becomes one predicate of ``spark.read.jdbc``:
one partition per month, read in parallel by the executors, with the bounds and the optional watermark pushed into every
predicate. Column pruning and further filters are pushed by Spark's JDBC
source. Connection details are the caller's JDBC URL and properties.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _d(x) -> dt.date:
    if isinstance(x, dt.datetime):
        return x.date()
    if isinstance(x, dt.date):
        return x
    return dt.date.fromisoformat(str(x)[:10])


def month_predicates(date_col: str, start, end, after=None) -> list[str]:
    """One ``WHERE`` predicate per calendar month that ``[start, end]`` touches,
    cut to those bounds (both days included), plus ``date > after`` for an
    incremental read (S2)."""
    lo, stop = _d(start), _d(end) + dt.timedelta(days=1)
    preds = []
    while lo < stop:
        following = (lo.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        hi = min(following, stop)
        p = f"{date_col} >= '{lo.isoformat()}' AND {date_col} < '{hi.isoformat()}'"
        if after is not None:
            p += f" AND {date_col} > '{_d(after).isoformat()}'"
        preds.append(p)
        lo = hi
    return preds


def read_by_month(spark: SparkSession, url: str, table: str, date_col: str, start, end,
                 columns: Sequence[str] | None = None, after=None,
                 properties: dict[str, str] | None = None) -> DataFrame:
    """The rows of ``table`` from ``start`` to ``end``, both days included, one
    JDBC partition per month."""
    df = spark.read.jdbc(url, table, predicates=month_predicates(date_col, start, end, after),
                         properties=properties or {})
    return df.select(*columns) if columns else df

"""Long <-> wide.

Wide rendering always pivots with an explicit value list. The list is read
from the data with a bounded probe: more distinct features than ``cap``
raises instead of silently truncating, and the caller keeps the long form
(e.g. UP scope). Rows of a wide frame are days, so the pivot itself shuffles
only the already aggregated counts, keyed by day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.session import materialize
from daymatrix.functions.names import qcol

PIVOT_CAP = 10_000  # spark.sql.pivotMaxValues default


class TooManyColumnsError(ValueError):
    pass


def bounded_values(df: DataFrame, column: str, cap: int = PIVOT_CAP) -> list:
    """Sorted distinct values of ``column``; raises past ``cap`` values."""
    vals = [r[0] for r in df.select(column).distinct().limit(cap + 1).collect()]
    if len(vals) > cap:
        raise TooManyColumnsError(
            f"more than {cap} distinct values in {column}; keep this output in long form"
        )
    return sorted(v for v in vals if v is not None)


def to_wide(long: DataFrame, key: str = "day", feature: str = "feature", value: str = "n",
            features: Sequence[str] | None = None, fill: int | float | None = 0,
            key_alias: str = "timestamp", cap: int = PIVOT_CAP, subset: bool = False) -> DataFrame:
    """``groupBy(key).pivot(feature, list).sum(value)``, missing cells -> ``fill``
    (R1/R2; duplicate keys are summed). With an explicit ``features`` list a
    feature outside it fails the job, unless the caller asks for a ``subset``."""
    if features is None:
        long = materialize(long)
        cols = bounded_values(long, feature, cap)
    else:
        cols = list(features)
    if len(cols) > cap:
        raise TooManyColumnsError(f"{len(cols)} columns requested, cap is {cap}")
    if features is not None and not subset:
        known = F.col(feature).isNull() | F.col(feature).isin(cols)
        long = long.withColumn(feature, F.when(known, F.col(feature)).otherwise(
            F.raise_error(F.concat(F.lit("feature outside the given columns: "), F.col(feature))).cast("string")))
    wide = long.groupBy(key).pivot(feature, cols).agg(F.sum(value))
    if not cols:
        wide = long.select(key).distinct()
    if fill is not None and cols:
        wide = wide.select(key, *[F.coalesce(qcol(c), F.lit(fill)).alias(c) for c in cols])
    if key_alias and key_alias != key:
        wide = wide.withColumnRenamed(key, key_alias)
    return wide


def to_long(wide: DataFrame, key: str = "timestamp", feature: str = "feature", value: str = "n",
            columns: Sequence[str] | None = None) -> DataFrame:
    """Wide -> long with ``unpivot``."""
    cols = list(columns) if columns is not None else [c for c in wide.columns if c != key]
    if not cols:
        return wide.select(key, F.lit(None).cast("string").alias(feature),
                           F.lit(None).cast("long").alias(value)).where(F.lit(False))
    return wide.unpivot([key], [qcol(c) for c in cols], feature, value)


def align_union(frames: Sequence[DataFrame], fill: int | float | None = 0) -> DataFrame:
    """Union by column name; absent columns -> ``fill``."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.fillna(fill) if fill is not None else out


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str] = ("timestamp",)) -> DataFrame:
    """``<prefix>_<col>`` for every column except ``keep``."""
    return df.select(*[qcol(c) if c in keep else qcol(c).alias(f"{prefix}_{c}") for c in df.columns])

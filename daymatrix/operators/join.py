"""Joins of daily series across domains.

The flagship join works in long form: each side is ``(feature, day, n)``.
Every feature is laid on the union of the two sides' day ranges (a
``sequence`` per feature, no cross join), zero inside its own side's range
(the sides are densified finals), null outside; then one fill per feature
(window partitioned by feature) and a last pivot to wide. The fill windows
therefore spread over the cluster instead of sorting a whole wide frame in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.operators.dedup import latest_wins
from daymatrix.operators.reshape import PIVOT_CAP, bounded_values, prefix_columns, to_wide
from daymatrix.operators.timeseries import _as_date, bounds, day_sequence, fill_series
from daymatrix.session import materialize_all


def join_daily_long(left: DataFrame, right: DataFrame, prefixes: tuple[str, str] = ("DEMAND", "DIAGNOSIS"),
                    fill_method: str | None = "ffill", feature: str = "feature", day: str = "day",
                    value: str = "n", densify_sides: bool = True) -> DataFrame:
    """Full outer join of two long daily frames on the day, with fills.

    Returns ``(feature, day, n)`` with features prefixed ``<prefix>_``. When
    either side is empty the result is empty (V5).
    """
    return _join_daily(left, right, prefixes, fill_method, feature, day, value, densify_sides)[0]


def _join_daily(left, right, prefixes, fill_method, feature, day, value, densify_sides):
    # Each side is an aggregate read by three jobs (bounds, names, result):
    # compute it once.
    left, right = materialize_all(left, right)
    lo_l, hi_l = bounds(left, day)
    lo_r, hi_r = bounds(right, day)
    if lo_l is None or lo_r is None:
        return left.select(feature, day, value).where(F.lit(False)), []
    lo_l, hi_l, lo_r, hi_r = map(_as_date, (lo_l, hi_l, lo_r, hi_r))
    lo, hi = min(lo_l, lo_r), max(hi_l, hi_r)
    in_left = F.col(day).between(F.lit(lo_l), F.lit(hi_l))
    in_right = F.col(day).between(F.lit(lo_r), F.lit(hi_r))
    in_union = in_left | in_right

    def side(df: DataFrame, prefix: str, tag: int) -> DataFrame:
        named = df.select(F.concat(F.lit(prefix + "_"), F.col(feature)).alias(feature), day,
                          F.col(value).cast("long").alias(value), F.lit(tag).alias("__side"))
        grid = named.select(feature, "__side").distinct().select(
            feature, F.explode(day_sequence(F.lit(lo), F.lit(hi))).alias(day),
            F.lit(None).cast("long").alias(value), "__side",
        ).where(in_union)
        return named.unionByName(grid)

    # Hash partitioning on the feature serves both the (feature, day) merge
    # and the fill window over each feature: one shuffle for both.
    rows = side(left, prefixes[0], 0).unionByName(side(right, prefixes[1], 1)).repartition(feature)
    both = rows.groupBy(feature, day, "__side").agg(F.sum(value).alias(value))
    if densify_sides:
        own = F.when(F.col("__side") == 0, in_left).otherwise(in_right)
        both = both.withColumn(value, F.when(own, F.coalesce(F.col(value), F.lit(0))).otherwise(F.col(value)))
    both = both.drop("__side")
    names = [f"{prefixes[0]}_{f}" for f in bounded_values(left, feature)] + \
        [f"{prefixes[1]}_{f}" for f in bounded_values(right, feature)]
    return fill_series(both, [feature], day, value, fill_method, zero_fill=True), names


def join_daily(left: DataFrame, right: DataFrame, prefixes: tuple[str, str] = ("DEMAND", "DIAGNOSIS"),
               fill_method: str | None = "ffill", cap: int = PIVOT_CAP,
               features: Sequence[str] | None = None) -> DataFrame:
    """Wide rendering of :func:`join_daily_long`: ``timestamp`` + one column per
    prefixed feature, sorted by day (Q3). ``features`` names the columns if
    they are known; else they are read from the data."""
    long, names = _join_daily(left, right, prefixes, fill_method, "feature", "day", "n", True)
    return to_wide(long, "day", "feature", "n", features=sorted(features or names), fill=0, key_alias="timestamp",
                   cap=cap).orderBy("timestamp")


def merge_wide(left: DataFrame, right: DataFrame, on_keys: Sequence[str] = ("timestamp",),
               left_prefix: str | None = None, right_prefix: str | None = "DIAG",
               order: str | None = "batch_id") -> DataFrame:
    """Multi-batch wide frames: latest batch wins per key on each side, the
    non-key columns get their prefix, then a full outer join on the keys
    (J8 with ``right_prefix='DIAG'``; J9 with both prefixes). No fills: a
    cell absent from a side stays null. Each side holds one row per key after
    the dedup, so the join cannot multiply rows (X28)."""
    keys = list(on_keys)

    def prep(df: DataFrame, prefix: str | None) -> DataFrame:
        if order is not None and order in df.columns:
            df = latest_wins(df, keys, order).drop(order)
        return prefix_columns(df, prefix, keep=keys) if prefix else df

    out = prep(left, left_prefix).join(prep(right, right_prefix), keys, "full")
    return out.orderBy(*keys)


def combine_long(frames: Sequence[DataFrame]) -> DataFrame:
    """Column-wise concat of several matrices, in long form: a union of their
    ``(feature, day, n)`` rows (J6, J7). Rendering with 0 fill is a pivot."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def add_counts(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str = "n") -> DataFrame:
    """Old + new aligned on both axes and added."""
    return old.unionByName(new, allowMissingColumns=True).groupBy(*keys).agg(
        F.sum(value).cast("long").alias(value)
    )

"""Small-side joins with a proven size bound.

A side is broadcast only after a bounded probe shows it holds at most
``max_rows`` rows; otherwise the join is left to a shuffle join (and AQE may
still convert it at run time). The probe is ``limit(max_rows + 1).count()``,
which stops reading as soon as the bound is exceeded.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.functions.clean import pad_unit_code, strip
from daymatrix.functions.names import qcol

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 << 20


_PROBED: "weakref.WeakKeyDictionary[DataFrame, dict[int, bool]]" = weakref.WeakKeyDictionary()


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``BROADCAST_MAX_BYTES`` of
    text. The answer is kept for the life of this DataFrame object, so a lookup
    shared by several joins of one job is probed once."""
    seen = _PROBED.setdefault(df, {})
    if max_rows not in seen:
        text = sum((F.coalesce(F.octet_length(qcol(c)), F.lit(0)) for c, kind in df.dtypes if kind == "string"), F.lit(0))
        n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(text)).first()
        seen[max_rows] = n <= max_rows and (size or 0) <= BROADCAST_MAX_BYTES
    return seen[max_rows]


def small_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when its rows and bytes are proven below the bounds."""
    return F.broadcast(df) if fits(df, max_rows) else df


def unit_region_lookup(lookup: DataFrame, code_col: str = "codi_up", region_col: str = "RS") -> DataFrame:
    """Normalised lookup ``(UP, RS)``: padded unit code, one region per unit.

    The reference joins an undeduplicated sheet, so a unit listed twice
    doubles its visits (X3); here a unit keeps one region, ``min(RS)``, and
    the conflicts are reported by ``lookup_conflicts``.
    """
    return (
        lookup.select(pad_unit_code(qcol(code_col)).alias("UP"),
                      F.nullif(strip(qcol(region_col)), F.lit("")).alias("RS"))
        .where(F.col("UP").isNotNull())
        .groupBy("UP")
        .agg(F.min("RS").alias("RS"))
    )


def lookup_conflicts(lookup: DataFrame, code_col: str = "codi_up", region_col: str = "RS") -> DataFrame:
    """Units listed with more than one distinct region."""
    return (
        lookup.select(pad_unit_code(qcol(code_col)).alias("UP"),
                      strip(qcol(region_col)).alias("RS"))
        .groupBy("UP")
        .agg(F.countDistinct("RS").alias("n_regions"), F.sort_array(F.collect_set("RS")).alias("regions"))
        .where(F.col("n_regions") > 1)
    )


def attach_region(df: DataFrame, lookup: DataFrame, unit_col: str = "UP",
                  max_rows: int = BROADCAST_MAX_ROWS, bound_by: DataFrame | None = None) -> DataFrame:
    """Left join of a normalised lookup on the unit code; adds raw ``RS``.

    ``bound_by`` is a frame with at least as many rows as ``lookup`` (the raw
    sheet it was aggregated from): probing it gives the same bound without
    running the aggregation, and its ``limit`` stops the scan early.
    """
    lk = lookup.withColumnRenamed("UP", "__lk_up")
    if fits(bound_by if bound_by is not None else lookup, max_rows):
        lk = F.broadcast(lk)
    return df.join(lk, F.col(unit_col) == F.col("__lk_up"), "left").drop("__lk_up")

"""Diagnosis: coded rows -> reduced counts -> grouped long counts.

The row-level table is reduced to ``(day, unit, 3-char code) -> n`` first
(Catalyst does not push an aggregate below a join, so the reduction is
written before the lookup). Region, chapter and subchapter are attached to
the reduced rows: the region by a size-checked broadcast join, chapter and
subchapter by ``CASE`` expressions over the ordered range lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.functions.clean import REGION_DEFAULT, day_of, pad_unit_code, strip
from daymatrix.functions.icd import (
    CHAPTER_RANGES,
    SUBCHAPTER_RANGES,
    classify_with_map,
    icd_code3_prefix,
    range_label,
)
from daymatrix.functions.names import qcol
from daymatrix.operators.demand import SCOPES, _stack, scoped_counts, variable_names
from daymatrix.operators.lookup import BROADCAST_MAX_ROWS, attach_region, small_side, unit_region_lookup
from daymatrix.schema import resolve_columns
from daymatrix.session import spread

LEVELS = ["ICD10_CHAPTER", "ICD10_SUBCHAPTER", "ICD10_3"]
RangeTable = Sequence[tuple[str, str, str]] | DataFrame


def canonical_diagnoses(raw: DataFrame, date_col: str = "data_visita", unit_col: str = "up_c",
                        code_col: str = "problema_salut_c") -> DataFrame:
    """Rename to ``DATA_VISITA, UP, DIAG_CODE`` (P13) after a case-insensitive
    presence check (V2)."""
    found = resolve_columns(raw, [date_col, unit_col, code_col])
    return raw.select(
        qcol(found[date_col]).alias("DATA_VISITA"),
        qcol(found[unit_col]).alias("UP"),
        qcol(found[code_col]).alias("DIAG_CODE"),
    )


def drop_incomplete(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """Drop count groups with a null key (F1), after counting.

    The predicate reads the count as well as the keys, so Catalyst keeps it
    above the aggregate; a plain null filter would be pushed below it and
    make every row evaluate the parse expressions twice (filter + project).
    Rows with an unknown key only add a few groups per day and unit.
    """
    complete = None
    for k in keys:
        c = F.col(k).isNotNull()
        complete = c if complete is None else complete & c
    return counts.where(F.when(complete, F.col(n)) > 0)


def _classify(df: DataFrame, ranges: RangeTable, out: str) -> DataFrame:
    if isinstance(ranges, DataFrame):
        return classify_with_map(df, "ICD10_3", ranges, out)
    return df.withColumn(out, range_label("ICD10_3", ranges))


def prepare_diagnoses(raw: DataFrame, lookup: DataFrame, date_col: str = "data_visita",
                      unit_col: str = "up_c", code_col: str = "problema_salut_c",
                      chapter_ranges: RangeTable = CHAPTER_RANGES,
                      subchapter_ranges: RangeTable = SUBCHAPTER_RANGES,
                      lookup_code_col: str = "codi_up", lookup_region_col: str = "RS",
                      max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Reduced diagnoses (A6): ``DATA_VISITA, UP, ICD10_3, RS, ICD10_CHAPTER,
    ICD10_SUBCHAPTER, n``. Rows without day, unit or a valid code are dropped
    (F1); a unit without region gets ``RS:SENSEESPECIFICAR_SE``. Rows are dealt
    by day and unit to tasks of a bounded number (a count of the table comes first)."""
    canon = canonical_diagnoses(raw, date_col, unit_col, code_col)
    rows = canon.select(
        day_of(canon, "DATA_VISITA").alias("DATA_VISITA"),
        pad_unit_code("UP").alias("UP"),
        icd_code3_prefix("DIAG_CODE").alias("ICD10_3"),
    )
    reduced = drop_incomplete(
        spread(rows, raw.count(), ["DATA_VISITA", "UP"]).groupBy("DATA_VISITA", "UP", "ICD10_3").agg(F.count(F.lit(1)).alias("n")),
        ["DATA_VISITA", "UP", "ICD10_3"],
    )
    lk = unit_region_lookup(lookup, lookup_code_col, lookup_region_col)
    out = attach_region(reduced, lk, "UP", max_broadcast_rows, bound_by=lookup).withColumn(
        "RS", F.coalesce(F.col("RS"), F.lit(REGION_DEFAULT))
    )
    out = _classify(out, chapter_ranges, "ICD10_CHAPTER")
    out = _classify(out, subchapter_ranges, "ICD10_SUBCHAPTER")
    return out.select("DATA_VISITA", "UP", "ICD10_3", "RS", "ICD10_CHAPTER", "ICD10_SUBCHAPTER",
                      F.col("n").cast("long").alias("n"))


def diagnosis_counts(reduced: DataFrame, scopes: Sequence[str] = SCOPES,
                     levels: Sequence[str] = LEVELS, include_total: bool = True,
                     selected_codes: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Daily diagnosis counts (A7-A9) in the canonical long schema.

    ``selected_codes`` restricts the ``ICD10_3`` level only (the all-level
    matrices of the reference); totals, chapters and subchapters always use
    every code. All levels are stacked and counted together, at the finest
    requested scope, then rolled up (see ``demand.scoped_counts``).
    """
    base = reduced.withColumnRenamed("DATA_VISITA", "day")
    names = variable_names(levels, include_total)
    if selected_codes is not None and "ICD10_3" in levels:
        if isinstance(selected_codes, DataFrame):
            sel = (selected_codes.select(F.upper(strip(F.col(selected_codes.columns[0]))).alias("__code"))
                   .distinct().withColumn("__sel", F.lit(True)))
            base = base.join(small_side(sel), F.col("ICD10_3") == F.col("__code"), "left")
            sel_col = F.coalesce(F.col("__sel"), F.lit(False))
        else:
            clean = sorted({str(c).strip().upper() for c in selected_codes if c is not None})
            sel_col = F.col("ICD10_3").isin(clean)
        base = base.withColumn("ICD10_3", F.when(sel_col, F.col("ICD10_3")))
        stacked = _stack(base, levels, include_total, ["day", "RS", "UP", "n"]).where(
            (F.col("variable") != names.index("ICD10_3")) | F.col("value").isNotNull()
        )
    else:
        stacked = _stack(base, levels, include_total, ["day", "RS", "UP", "n"])
    return scoped_counts(stacked, scopes, {"RS": "RS", "UP": "UP"}, F.sum("n"), "diagnosis", names)


def grouped_long(reduced: DataFrame, code_col: str, group_col: str | None = None) -> DataFrame:
    """One reference dataset (A9): ``DATA_VISITA, [group], <code_col>, n, LEVEL``."""
    keys = ["DATA_VISITA", code_col] if group_col is None else ["DATA_VISITA", group_col, code_col]
    return reduced.groupBy(*keys).agg(F.sum("n").cast("long").alias("n")).withColumn("LEVEL", F.lit(code_col))


def daily_total(reduced: DataFrame) -> DataFrame:
    """``DATA_VISITA, DIAG_TOTAL``."""
    return reduced.groupBy("DATA_VISITA").agg(F.sum("n").cast("long").alias("DIAG_TOTAL"))


def raw_code_rows(raw: DataFrame, lookup: DataFrame | None = None, date_col: str = "data_visita",
                  unit_col: str = "up_c", code_col: str = "problema_salut_c",
                  selected_codes: Sequence[str] | DataFrame | None = None,
                  max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Rows of the optimized diagnosis path: day, padded unit, stripped raw code,
    optional raw-equality filter on a code list (F3, X19), region with
    ``UNKNOWN`` for unmatched units (J3)."""
    canon = canonical_diagnoses(raw, date_col, unit_col, code_col)
    rows = canon.where(day_of(canon, "DATA_VISITA").isNotNull() & F.col("DIAG_CODE").isNotNull()).select(
        day_of(canon, "DATA_VISITA").alias("day"),
        pad_unit_code("UP").alias("UP"),
        strip("DIAG_CODE").alias("DIAG_CODE"),
    )
    if selected_codes is not None:
        if isinstance(selected_codes, DataFrame):
            sel = selected_codes.select(strip(F.col(selected_codes.columns[0])).alias("__code")).distinct()
            rows = rows.join(small_side(sel, max_broadcast_rows), F.col("DIAG_CODE") == F.col("__code"), "left_semi")
        else:
            rows = rows.where(F.col("DIAG_CODE").isin(list(selected_codes)))
    if lookup is not None:
        rows = attach_region(rows, unit_region_lookup(lookup), "UP", max_broadcast_rows).withColumn(
            "RS", F.coalesce(F.col("RS"), F.lit("UNKNOWN"))
        )
    return rows


def code_daily(rows: DataFrame, group_col: str | None = None) -> DataFrame:
    """Daily raw-code counts (A10), optionally per group."""
    keys = ["day", "DIAG_CODE"] if group_col is None else ["day", group_col, "DIAG_CODE"]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def code_daily_by_region(rows: DataFrame, lookup: DataFrame, max_broadcast_rows: int = BROADCAST_MAX_ROWS,
                         n_rows: int | None = None) -> DataFrame:
    """Daily raw-code counts per region (A11), unmatched units ``UNKNOWN`` (J3):
    rows without region are counted by unit first, so that counts and not rows
    meet the lookup. ``n_rows`` is the number of rows, if known."""
    n_rows = rows.count() if n_rows is None else n_rows
    counted = spread(rows, n_rows, ["day", "UP"]).groupBy("day", "UP", "DIAG_CODE").agg(F.count(F.lit(1)).alias("n"))
    named = attach_region(counted, unit_region_lookup(lookup), "UP", max_broadcast_rows, bound_by=lookup)
    return spread(named, n_rows, ["day", "DIAG_CODE"]).groupBy("day", F.coalesce("RS", F.lit("UNKNOWN")).alias("RS"), "DIAG_CODE").agg(F.sum("n").alias("n"))


__all__ = [
    "LEVELS", "canonical_diagnoses", "prepare_diagnoses",
    "diagnosis_counts", "grouped_long", "daily_total", "raw_code_rows", "code_daily", "code_daily_by_region",
]

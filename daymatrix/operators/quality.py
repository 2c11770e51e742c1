"""Data-quality reports (V3-V5).

Reports are distributed aggregations; only the documented samples use a
``limit`` (the sample is the feature).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.functions.clean import day_of, has_text
from daymatrix.functions.icd import CHAPTER_RANGES, icd_normalize, icd_ordinal, range_map, ranges_frame
from daymatrix.operators.diagnosis import canonical_diagnoses
from daymatrix.operators.lookup import BROADCAST_MAX_ROWS, small_side, unit_region_lookup


def unknown_codes(raw: DataFrame, chapter_ranges=CHAPTER_RANGES, limit: int | None = 100,
                  **cols) -> DataFrame:
    """Distinct original codes whose chapter is UNKNOWN (V3, X17): valid
    3-character codes outside every chapter range, ordered by the original
    code; ``limit`` is the report size (``None`` for all).

    Codes are de-duplicated first, then anti-joined with the range map
    (at most 2,600 ordinals, broadcast) on the code ordinal.
    """
    canon = canonical_diagnoses(raw, **cols)
    # Rows with a day and a unit; the codes are de-duplicated before they are
    # parsed, so the parse runs once per distinct code, not once per row.
    codes = (canon.where(day_of(canon, "DATA_VISITA").isNotNull() & has_text("UP"))
             .select("DIAG_CODE").distinct())
    rows = codes.select("DIAG_CODE", icd_normalize("DIAG_CODE").alias("ICD10_CODE")) \
        .where(F.col("ICD10_CODE").isNotNull()) \
        .select("DIAG_CODE", "ICD10_CODE", F.substring("ICD10_CODE", 1, 3).alias("ICD10_3"))
    ranges = chapter_ranges if isinstance(chapter_ranges, DataFrame) else \
        ranges_frame(raw.sparkSession, chapter_ranges)
    covered = F.broadcast(range_map(ranges).select("ordinal"))
    out = (rows.join(covered, icd_ordinal("ICD10_3") == covered["ordinal"], "left_anti")
           .orderBy("DIAG_CODE"))
    return out.limit(limit) if limit is not None else out


def unmatched_units(rows: DataFrame, lookup: DataFrame, unit_col: str = "UP",
                    max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Rows per unit that has no region in the lookup (V4): rows are counted by
    unit, and the units that the lookup lists are taken out."""
    lk = small_side(unit_region_lookup(lookup).select(F.col("UP").alias("__lk_up")), max_broadcast_rows)
    counted = rows.groupBy(unit_col).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(lk, F.col(unit_col) == F.col("__lk_up"), "left_anti")


def both_present(left: DataFrame, right: DataFrame) -> bool:
    """Empty-side guard (V5)."""
    return not left.isEmpty() and not right.isEmpty()


def unmatched_units_sample(rows: DataFrame, lookup: DataFrame, n: int = 10, unit_col: str = "UP") -> DataFrame:
    """The first ``n`` unmatched units by code with their row counts (O3)."""
    return unmatched_units(rows, lookup, unit_col).orderBy(unit_col).limit(n)

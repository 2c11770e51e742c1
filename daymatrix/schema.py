"""The canonical long schema and input checks (V1, V2)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Every daily count lives in this one long schema; wide is a rendering.
DAILY_COUNTS = T.StructType([
    T.StructField("day", T.DateType()),
    T.StructField("domain", T.StringType()),       # demand | diagnosis
    T.StructField("scope", T.StringType()),        # CAT | RS | UP
    T.StructField("group_value", T.StringType()),  # null for CAT
    T.StructField("variable", T.StringType()),     # e.g. TIPUS_CLASS, ICD10_CHAPTER, TOTAL
    T.StructField("value", T.StringType()),        # null for TOTAL
    T.StructField("n", T.LongType()),
])
FEATURE_KEY = ["domain", "scope", "group_value", "variable", "value"]
COUNT_KEY = FEATURE_KEY + ["day"]

VISIT_COLUMNS = ["DATA_VISITA", "UP", "VISI_LLOC_VISITA", "VISI_SITUACIO_VISITA", "SERVEI_CODI"]
DIAGNOSIS_COLUMNS = ["DATA_VISITA", "UP", "DIAG_CODE"]


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Exact check; raises with the sorted list of missing names (V1)."""
    missing = sorted(set(required).difference(df.columns))
    if missing:
        raise MissingColumnsError(f"Missing required columns: {missing}")


def resolve_columns(df: DataFrame, required: Iterable[str]) -> dict[str, str]:
    """Case-insensitive check (V2): maps each required name to the actual
    column; raises listing the missing names and what is available."""
    by_lower = {c.lower(): c for c in df.columns}
    found, missing = {}, []
    for name in required:
        actual = by_lower.get(name.lower())
        if actual is None:
            missing.append(name)
        else:
            found[name] = actual
    if missing:
        raise MissingColumnsError(
            f"Missing required columns: {sorted(missing)}; available: {sorted(df.columns)}"
        )
    return found

"""Feature names of the fixture views, by rule.

The fixtures fix the values of every counted column, so the columns of each
wide rendering are known before any row is read. The registered jobs render
with these lists, and the DuckDB statements name the same columns; a feature
outside its list fails the rendering (see ``reshape.to_wide``).
"""

from __future__ import annotations

from collections.abc import Sequence

from daymatrix.functions.icd import CHAPTER_RANGES, SELECTED_CODES, SUBCHAPTER_RANGES, UNKNOWN
from daymatrix.operators.diagnosis import LEVELS

_DEFAULT_REGION = "RS:SENSEESPECIFICAR_SE"
DEMAND_REGIONS = [*(f"RS{i}" for i in range(5)), _DEFAULT_REGION]
DIAGNOSIS_REGIONS = [*DEMAND_REGIONS, "SENSEESPECIFICAR_SE"]

DEMAND_VALUES = {
    "VISI_LLOC_VISITA": ["F", "O", "P"],
    "VISI_SITUACIO_VISITA": ["1", "2", "3", "4", "5", "NA"],
    "SERVEI_CODI": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "TIPUS_CLASS": ["9T", "C9C", "C9R", "CALTRE", "D9D", "DALTRE", "NA", "ZZ"],
    "TIPUS_VISITA_AGRUPAT": ["DOMICILIARIA", "NA", "PRESENCIAL", "TELEFONICA"],
}


def _names(ranges) -> list[str]:
    return [*dict.fromkeys(name for name, _, _ in ranges), UNKNOWN]


LEVEL_VALUES = {
    "ICD10_CHAPTER": ("CHAPTER", _names(CHAPTER_RANGES)),
    "ICD10_SUBCHAPTER": ("SUBCHAPTER", _names(SUBCHAPTER_RANGES)),
    "ICD10_3": ("ICD10_3", sorted(set(SELECTED_CODES))),
}


def demand_features(scope: str) -> list[str]:
    """Columns of the demand matrix at scope CAT or RS."""
    if scope == "CAT":
        return sorted(["demanda__TOTAL_CAT", *(f"demanda__{c}__{v}" for c, vs in DEMAND_VALUES.items() for v in vs)])
    return sorted(name for r in DEMAND_REGIONS for name in (
        f"demanda__TOTAL_{scope}_{r}", *(f"demanda_{c}_{v}_{r}" for c, vs in DEMAND_VALUES.items() for v in vs)))


def diagnosis_features(scope: str, levels: Sequence[str] = tuple(LEVELS), total: bool = True) -> list[str]:
    """Columns of the diagnosis matrix at scope CAT or RS."""
    pairs = [(prefix, v) for level in levels for prefix, vs in [LEVEL_VALUES[level]] for v in vs]
    if scope == "CAT":
        return sorted([*(["TOTAL"] if total else []), *(f"{p}_{v}" for p, v in pairs)])
    return sorted(name for r in DIAGNOSIS_REGIONS for name in (
        *([f"TOTAL__{scope}__{r}"] if total else []), *(f"{p}__{v}__{scope}__{r}" for p, v in pairs)))


def joined_features() -> list[str]:
    """Columns of the flagship matrix."""
    return sorted([*(f"DEMAND_{f}" for f in demand_features("CAT")), *(f"DIAGNOSIS_{f}" for f in diagnosis_features("CAT"))])

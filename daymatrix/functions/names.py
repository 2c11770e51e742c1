"""Feature-name rendering for wide matrices.

A feature is identified in long form by ``(domain, scope, group_value,
variable, value)``; these expressions render the column names the reference
writes. Names are kept exactly, including the different CAT and group styles
(X21).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def qcol(name: str) -> Column:
    """A column by its exact name: feature names come from data and may hold
    dots, spaces or backticks, which ``F.col(name)`` would parse."""
    return F.col("`" + name.replace("`", "``") + "`")


# Name prefixes.
DEMAND_PREFIX = "demanda"
TOTAL = "TOTAL"
DIAGNOSIS_LEVEL_PREFIX = {
    "ICD10_CHAPTER": "CHAPTER",
    "ICD10_SUBCHAPTER": "SUBCHAPTER",
    "ICD10_3": "ICD10_3",
}


def demand_feature(scope: Column, group_value: Column, variable: Column, value: Column,
                   prefix: str = DEMAND_PREFIX) -> Column:
    """CAT: ``demanda__TOTAL_CAT`` / ``demanda__<var>__<value>``;
    group: ``demanda__TOTAL_<scope>_<group>`` / ``demanda_<var>_<value>_<group>``."""
    is_total = variable == F.lit(TOTAL)
    is_cat = scope == F.lit("CAT")
    return (
        F.when(is_cat & is_total, F.lit(f"{prefix}__TOTAL_CAT"))
        .when(is_cat, F.concat(F.lit(f"{prefix}__"), variable, F.lit("__"), value))
        .when(is_total, F.concat(F.lit(f"{prefix}__TOTAL_"), scope, F.lit("_"), group_value))
        .otherwise(F.concat(F.lit(f"{prefix}_"), variable, F.lit("_"), value, F.lit("_"), group_value))
    )


def diagnosis_feature(scope: Column, group_value: Column, variable: Column, value: Column) -> Column:
    """CAT: ``TOTAL`` / ``CHAPTER_<x>``; group: ``TOTAL__<scope>__<g>`` /
    ``CHAPTER__<x>__<scope>__<g>`` (likewise SUBCHAPTER, ICD10_3)."""
    prefix = F.coalesce(
        *[F.when(variable == F.lit(k), F.lit(v)) for k, v in DIAGNOSIS_LEVEL_PREFIX.items()],
        variable,
    )
    is_total = variable == F.lit(TOTAL)
    is_cat = scope == F.lit("CAT")
    return (
        F.when(is_cat & is_total, F.lit(TOTAL))
        .when(is_cat, F.concat(prefix, F.lit("_"), value))
        .when(is_total, F.concat(F.lit("TOTAL__"), scope, F.lit("__"), group_value))
        .otherwise(F.concat(prefix, F.lit("__"), value, F.lit("__"), scope, F.lit("__"), group_value))
    )


def feature_name(domain: Column, scope: Column, group_value: Column, variable: Column,
                 value: Column) -> Column:
    return F.when(domain == F.lit("demand"), demand_feature(scope, group_value, variable, value)) \
        .otherwise(diagnosis_feature(scope, group_value, variable, value))


def with_feature(df, out: str = "feature"):
    """Add the rendered feature name to a ``daily_counts`` frame."""
    return df.withColumn(
        out,
        feature_name(F.col("domain"), F.col("scope"), F.col("group_value"),
                     F.col("variable"), F.col("value")),
    )

"""Demand: visits -> cleaned rows -> daily counts at CAT/RS/UP.

One plan for every scope and variable: the five label columns and the total
are stacked into ``(variable, value)`` rows with a generator and counted. For
units the visits are shuffled before they are stacked, by day and unit, in tasks
of a bounded number of rows: there are about as many groups as rows, and no day of
a unit is large. With further scopes the stacked rows are shuffled so, and regions
and the whole territory are rolled up from the counts (see ``scoped_counts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymatrix.functions.clean import (
    clean_label,
    day_of,
    region_label,
    unit_label,
    visit_class,
    visit_class_group,
)
from daymatrix.operators.lookup import BROADCAST_MAX_ROWS, attach_region, unit_region_lookup
from daymatrix.schema import VISIT_COLUMNS, require_columns
from daymatrix.session import spread

# The five demand variables.
DEMAND_VARIABLES = [
    "VISI_LLOC_VISITA",
    "VISI_SITUACIO_VISITA",
    "SERVEI_CODI",
    "TIPUS_CLASS",
    "TIPUS_VISITA_AGRUPAT",
]
SCOPES = ("CAT", "RS", "UP")
TOTAL = "TOTAL"


def clean_visits(visits: DataFrame, date_formats: Sequence[str] | None = None) -> DataFrame:
    """Row-level cleaning without the lookup: day, padded unit, labels, class
    and class group; rows without a parsable day are dropped (P1-P6, P8)."""
    require_columns(visits, VISIT_COLUMNS)
    tipus = visit_class("TIPUS_CLASS" if "TIPUS_CLASS" in visits.columns else None)
    return (
        visits.select(
            day_of(visits, "DATA_VISITA", date_formats).alias("day"),
            unit_label("UP").alias("UP"),
            clean_label("VISI_LLOC_VISITA").alias("VISI_LLOC_VISITA"),
            clean_label("VISI_SITUACIO_VISITA").alias("VISI_SITUACIO_VISITA"),
            clean_label("SERVEI_CODI").alias("SERVEI_CODI"),
            tipus.alias("TIPUS_CLASS"),
        )
        .where(F.col("day").isNotNull())
        .withColumn("TIPUS_VISITA_AGRUPAT", visit_class_group("TIPUS_CLASS"))
    )


def prepare_visits(visits: DataFrame, lookup: DataFrame, date_formats: Sequence[str] | None = None,
                   code_col: str = "codi_up", region_col: str = "RS",
                   max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Cleaned visits with their region (J1, P7): unit code stripped, padded,
    then looked up; no region -> ``RS:SENSEESPECIFICAR_SE``."""
    rows = clean_visits(visits, date_formats)
    lk = unit_region_lookup(lookup, code_col, region_col)
    return attach_region(rows, lk, "UP", max_broadcast_rows, bound_by=lookup).withColumn(
        "RS", region_label("RS"))


def variable_names(variables: Sequence[str], include_total: bool) -> list[str]:
    """What is counted, in the order of the stacked ``variable`` numbers."""
    names = [*([TOTAL] if include_total else []), *variables]
    if not names:
        raise ValueError("nothing to count: no variables and no total")
    return names


def _stack(df: DataFrame, variables: Sequence[str], include_total: bool, keep: Sequence[str]) -> DataFrame:
    """One row per counted variable: its number among ``variable_names`` (a byte
    in the aggregation's keys instead of a text) and its value."""
    pairs = [
        F.struct(F.lit(i).cast("tinyint").alias("variable"),
                 (F.lit(None) if v == TOTAL and include_total and i == 0 else F.col(v)).cast("string").alias("value"))
        for i, v in enumerate(variable_names(variables, include_total))
    ]
    return df.select(*keep, F.inline(F.array(*pairs)))


def _scope_rows(df: DataFrame, scope: str | Column, group_value: Column, domain: str, names: Sequence[str]) -> DataFrame:
    named = F.element_at(F.array(*(F.lit(n) for n in names)), F.col("variable") + 1)
    return df.select(
        "day", F.lit(domain).alias("domain"), (F.lit(scope) if isinstance(scope, str) else scope).alias("scope"),
        group_value.alias("group_value"), named.alias("variable"), "value", F.col("n").cast("long").alias("n"),
    )


def _group_value(scope: str, group_cols: dict[str, str]) -> Column:
    return F.lit(None).cast("string") if scope == "CAT" else F.col(group_cols[scope])


def scoped_counts(stacked: DataFrame, scopes: Sequence[str], group_cols: dict[str, str],
                  measure: Column, domain: str, names: Sequence[str]) -> DataFrame:
    """Count ``stacked`` rows per ``(day, [group], variable, value)`` for every
    requested scope; returns the canonical long schema. Variables are numbers in
    the aggregations and get their ``names`` after them.

    Units nest in regions (one region per unit), so the counts roll up:
    the row-level input is aggregated once, at the finest requested scope
    (keeping the region next to the unit), and the coarser scopes are summed
    from that result with one grouping-sets aggregation. The map-side work on
    the big input is one hash aggregation per stacked row (a grouping-sets
    ``Expand`` over the raw rows would triple it); the second shuffle only
    carries already aggregated counts, and the first one is reused by both
    branches of the union.
    """
    unknown = set(scopes) - set(SCOPES)
    if unknown:
        raise ValueError(f"unknown scopes: {sorted(unknown)}")
    order = [s for s in ("UP", "RS", "CAT") if s in scopes]
    finest = order[0]
    if finest == "UP" and len(order) > 1:   # read by both branches of the union
        stacked = stacked.repartition("day", group_cols["UP"])
    keys = {"UP": [group_cols["RS"], group_cols["UP"]], "RS": [group_cols["RS"]], "CAT": []}[finest]
    base = stacked.groupBy("day", *keys, "variable", "value").agg(measure.alias("n"))
    out = _scope_rows(base, finest, _group_value(finest, group_cols), domain, names)
    coarser = order[1:]
    if len(coarser) == 1:
        scope = coarser[0]
        gkeys = [] if scope == "CAT" else [group_cols[scope]]
        rolled = base.groupBy("day", *gkeys, "variable", "value").agg(F.sum("n").alias("n"))
        out = out.unionByName(_scope_rows(rolled, scope, _group_value(scope, group_cols), domain, names))
    elif len(coarser) == 2:  # RS and CAT from UP
        rs = group_cols["RS"]
        rolled = base.groupingSets(
            [["day", rs, "variable", "value"], ["day", "variable", "value"]], "day", rs, "variable", "value"
        ).agg(F.sum("n").alias("n"), F.grouping(rs).alias("__g_rs"))
        by_rs = F.col("__g_rs") == 0
        out = out.unionByName(_scope_rows(rolled, F.when(by_rs, F.lit("RS")).otherwise(F.lit("CAT")), F.when(by_rs, F.col(rs)), domain, names))
    return out


def demand_counts(prepared: DataFrame, scopes: Sequence[str] = SCOPES,
                  variables: Sequence[str] = DEMAND_VARIABLES, include_total: bool = True,
                  rows: int | None = None) -> DataFrame:
    """Daily visit counts (A1-A5) as ``daily_counts`` rows with domain ``demand``.
    ``rows`` is the number of visits, if known (else they are counted where UP is the only scope)."""
    if tuple(scopes) == ("UP",):
        n = len(variable_names(variables, include_total))
        prepared = spread(prepared, prepared.count() if rows is None else rows, ["day", "UP"], n)
    stacked = _stack(prepared, variables, include_total, ["day", "RS", "UP"])
    return scoped_counts(stacked, scopes, {"RS": "RS", "UP": "UP"}, F.count(F.lit(1)), "demand",
                         variable_names(variables, include_total))

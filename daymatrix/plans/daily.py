"""End-to-end daily jobs.

Each job is one lazy plan per output: scan -> clean -> count -> render,
written with Spark's commit protocol. Counts are stored in long form
(canonical ``daily_counts``); wide matrices are rendered for CAT and RS only,
UP stays long (its column count grows with units x values).
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import quote
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymatrix.functions.clean import REGION_DEFAULT, region_label
from daymatrix.functions.icd import SELECTED_CODES
from daymatrix.functions.names import with_feature
from daymatrix.operators.demand import SCOPES, demand_counts, prepare_visits
from daymatrix.operators.diagnosis import LEVELS, diagnosis_counts, prepare_diagnoses
from daymatrix.operators.join import combine_long, join_daily
from daymatrix.operators.lookup import small_side, unit_region_lookup
from daymatrix.operators.reshape import bounded_values, to_wide
from daymatrix.operators.timeseries import bounds, densify_wide
from daymatrix.plans import incremental as inc
from daymatrix.session import materialize
from daymatrix.sources import blocks, store


class MissingInputError(FileNotFoundError):
    pass


def _named(long: DataFrame) -> DataFrame:
    return with_feature(long).select("day", "feature", "n")


StateError = inc.StateError


def _check_state(spark: SparkSession, store_path: str, state_path: str | None) -> None:
    """The watermark file is a copy, for other tools, of what the store records
    with its data. It may be behind the store (a run that ended before writing
    it) but not ahead of it: then stored days have been lost, and going on would
    leave a gap for good."""
    inc.apply_pending(spark, store_path)
    recorded = store.load_state(spark, state_path) if state_path is not None else None
    stored = inc.stored_hwm(spark, store_path) if recorded is not None else None
    if recorded is not None and (stored is None or stored < recorded):
        raise StateError(f"state says {recorded}, the store ends at {stored}: restore it, or drop the state to load all again")


def _record(spark: SparkSession, info: inc.RunInfo, state_path: str | None, run_at: dt.datetime | None):
    if state_path is not None and info.hwm_after is not None:
        store.save_state(spark, state_path, info.hwm_after, run_at)
    return info


def run_demand_increment(visits: DataFrame, lookup: DataFrame, store_path: str,
                         as_of: dt.date, lookback_days: int = 0, min_valid: dt.date | None = None,
                         state_path: str | None = None, run_at: dt.datetime | None = None) -> inc.RunInfo:
    """Recount the days from the stored watermark on and replace them;
    the store records ``(last_loaded_date, updated_at)`` (I3, clock given), and
    ``state_path`` takes a copy."""
    _check_state(visits.sparkSession, store_path, state_path)
    info = inc.run_recount(visits, "DATA_VISITA", lambda rows: demand_counts(prepare_visits(rows, lookup), rows=rows.count()),
                           store_path, as_of, lookback_days, min_valid, run_at=run_at)
    return _record(visits.sparkSession, info, state_path, run_at)


def run_diagnosis_increment(diagnoses: DataFrame, lookup: DataFrame, store_path: str,
                            as_of: dt.date, lookback_days: int = 0, min_valid: dt.date | None = None,
                            selected_codes: Sequence[str] | DataFrame = SELECTED_CODES,
                            date_col: str = "data_visita", state_path: str | None = None,
                            run_at: dt.datetime | None = None) -> inc.RunInfo:
    """As I1 for diagnoses (all levels; ICD10_3 restricted to the selection)."""
    _check_state(diagnoses.sparkSession, store_path, state_path)
    info = inc.run_recount(
        diagnoses, date_col,
        lambda rows: diagnosis_counts(prepare_diagnoses(rows, lookup), selected_codes=selected_codes),
        store_path, as_of, lookback_days, min_valid, run_at=run_at)
    return _record(diagnoses.sparkSession, info, state_path, run_at)


def render_matrices(counts: DataFrame, out_dir: str, domain_prefix: str, start=None, end=None,
                    wide_scopes: Sequence[str] = ("CAT", "RS")) -> dict[str, str]:
    """I8/I9 final build. The counts are computed once and stored in long
    form partitioned by scope and variable (S9); every wide matrix is then
    rendered from the stored dataset (partition pruning on ``scope``):
    dense over ``[start, end]`` (default: the scope's own first and last day),
    written as Parquet + CSV (S8). Returns name -> path."""
    spark = counts.sparkSession
    outputs = {}
    long_path = f"{out_dir}/{domain_prefix}_long"
    # Clustered by folder, so that not every task writes into every one; AQE
    # splits a large folder over several tasks.
    store.save_final(counts.hint("rebalance", "scope", "variable"), long_path, partition_by=["scope", "variable"])
    outputs[f"{domain_prefix}_long"] = long_path
    stored = spark.read.parquet(long_path)
    for scope in wide_scopes:
        named = _named(stored.where(F.col("scope") == scope))
        lo, hi = bounds(named, "day")
        lo, hi = (start or lo), (end or hi)
        wide = to_wide(named, features=bounded_values(named, "feature"))
        if lo is not None and hi is not None:
            wide = densify_wide(wide, "timestamp", lo, hi)
        path = f"{out_dir}/{domain_prefix}_{scope.lower()}"
        store.save_matrix(wide, path)
        outputs[f"{domain_prefix}_{scope.lower()}"] = f"{path}.parquet"
    return outputs


def demand_final(spark: SparkSession, visits: DataFrame, lookup: DataFrame, out_dir: str,
                 start=None, end=None, up_matrices: bool = False) -> dict[str, str]:
    """Q1: visits -> counts at every scope -> long dataset, densified CAT/RS
    matrices and the UP matrices of all regions in blocks of columns."""
    counts = demand_counts(prepare_visits(visits, lookup), SCOPES, rows=visits.count())
    outputs = render_matrices(counts, out_dir, "demand", start, end)
    if up_matrices:
        stored = spark.read.parquet(outputs["demand_long"])
        outputs["demand_up"] = write_up_blocks(stored, lookup, f"{out_dir}/demand_up", start, end)
    return outputs


def diagnosis_final(spark: SparkSession, diagnoses: DataFrame, lookup: DataFrame, out_dir: str,
                    selected_codes: Sequence[str] | DataFrame = SELECTED_CODES,
                    start=None, end=None, up_matrices: bool = False) -> dict[str, str]:
    """Q2: diagnoses -> reduced -> all-level counts at every scope -> outputs.

    The nine grouped-long datasets of the reference (level x CAT/RS/UP) are
    the ``diagnosis_long`` dataset's ``scope=/variable=`` partitions; the
    all-level matrices are rendered for CAT and RS, and for UP in blocks."""
    counts = diagnosis_counts(prepare_diagnoses(diagnoses, lookup), SCOPES, LEVELS, True, selected_codes)
    outputs = render_matrices(counts, out_dir, "diagnosis", start, end)
    if up_matrices:
        stored = spark.read.parquet(outputs["diagnosis_long"])
        outputs["diagnosis_up"] = write_up_blocks(stored, lookup, f"{out_dir}/diagnosis_up", start, end)
    return outputs


def _unit_regions(counts: DataFrame, lookup: DataFrame, region: str) -> DataFrame:
    """UP counts by feature, with the region of the unit (none ->
    ``RS:SENSEESPECIFICAR_SE``)."""
    lk = unit_region_lookup(lookup).select(F.col("UP").alias("__unit"), region_label("RS").alias(region))
    up = (counts.where(F.col("scope") == "UP")
          .join(small_side(lk), F.col("group_value") == F.col("__unit"), "left")
          .withColumn(region, F.coalesce(region, F.lit(REGION_DEFAULT))))
    return with_feature(up).select("day", "feature", "n", region)


def write_up_blocks(counts: DataFrame, lookup: DataFrame, path: str, start=None, end=None) -> str:
    """The UP matrices (I8, I9) of all regions, dense over ``[start, end]``
    (default: the first and last day of any unit), one matrix a region, in blocks
    of columns written by one job (``sources.blocks``): no list of regions or
    columns is collected, and neither has a limit."""
    lo, hi = bounds(counts.where(F.col("scope") == "UP"), "day")
    lo, hi = (start or lo), (end or hi)
    return blocks.write_blocks(_unit_regions(counts, lookup, blocks.MATRIX), [(lo, hi)] if lo is not None and hi is not None else [], path)


def joined_final(spark: SparkSession, demand_counts_df: DataFrame, diagnosis_counts_df: DataFrame,
                 out_path: str, fill_method: str | None = "ffill", compression: str = "snappy") -> str:
    """Q3: CAT demand and diagnosis matrices joined on the day with fills."""
    dem = _named(demand_counts_df.where(F.col("scope") == "CAT"))
    dia = _named(diagnosis_counts_df.where(F.col("scope") == "CAT"))
    store.save_final(join_daily(dem, dia, ("DEMAND", "DIAGNOSIS"), fill_method), out_path, compression)
    return out_path


def historical_combined(spark: SparkSession, long_paths: Sequence[str], out_path: str,
                        wide: bool = False) -> str:
    """Every stored long dataset combined into one feature table;
    any missing input is an error, not a silent gap. ``wide=True`` writes the
    zero-filled wide rendering instead (one row per day, sorted), which raises
    past the pivot cap rather than dropping columns."""
    missing = [p for p in long_paths if not store.path_exists(spark, p)]
    if missing:
        raise MissingInputError(f"missing inputs: {missing}")
    combined = combine_long([_named(spark.read.parquet(p)) for p in long_paths])
    if wide:
        combined = to_wide(combined).orderBy("timestamp")
    store.save_final(combined, out_path)
    return out_path


def historical_blocks(spark: SparkSession, long_paths: Sequence[str], out_path: str) -> str:
    """Q4, J6, S16 as a zero-filled matrix: the CAT, RS and UP matrices of all
    stored long datasets side by side over the days of any of them (each from its
    own first to its last day), in blocks of columns. The block index names each
    column's matrix, ``<domain>_<scope>``. A missing input is an error."""
    missing = [p for p in long_paths if not store.path_exists(spark, p)]
    if missing:
        raise MissingInputError(f"missing inputs: {missing}")
    matrix = F.lower(F.concat_ws("_", "domain", "scope")).alias(blocks.MATRIX)
    combined = combine_long([with_feature(spark.read.parquet(p)).select(matrix, "day", "feature", "n") for p in long_paths])
    spans = combined.groupBy(blocks.MATRIX).agg(F.min("day").alias("lo"), F.max("day").alias("hi")).collect()  # a row a matrix
    return blocks.write_blocks(combined, [(r["lo"], r["hi"]) for r in spans if r["lo"] is not None], out_path)


def build_all(spark: SparkSession, visits: DataFrame, diagnoses: DataFrame, lookup: DataFrame,
              out_dir: str) -> dict[str, str]:
    """The whole daily build: demand and diagnosis outputs (Q1, Q2), then the
    joined matrix (Q3) from the stored long counts.

    The two domains are independent until the join, so their jobs are
    submitted from two driver threads and run side by side on the cluster
    (Spark schedules concurrent jobs of one application); each one's small
    jobs fill the gaps of the other.
    """
    with ThreadPoolExecutor(max_workers=2) as pool:
        demand = pool.submit(demand_final, spark, visits, lookup, out_dir)
        diagnosis = pool.submit(diagnosis_final, spark, diagnoses, lookup, out_dir)
        outputs = {**demand.result(), **diagnosis.result()}
    dem = spark.read.parquet(outputs["demand_long"])
    dia = spark.read.parquet(outputs["diagnosis_long"])
    outputs["joined"] = joined_final(spark, dem, dia, f"{out_dir}/joined")
    return outputs


def render_up_by_region(counts: DataFrame, lookup: DataFrame, out_dir: str, domain_prefix: str,
                        start=None, end=None, max_regions: int = 1_000) -> dict[str, str]:
    """UP-scope matrices rendered one region at a time (I8/I9 UP outputs).

    For a few regions of some thousand columns each, under their own names, as
    Parquet and CSV: the loop is over the list of regions, each region's pivot is
    one distributed job, and one past the pivot cap raises rather than truncating.
    :func:`write_up_blocks` has no such bounds.
    """
    spark = counts.sparkSession
    up = materialize(_unit_regions(counts, lookup, "__region"))
    lo, hi = bounds(up, "day")
    lo, hi = (start or lo), (end or hi)
    outputs = {}
    for region in bounded_values(up, "__region", max_regions):
        named = up.where(F.col("__region") == region).drop("__region")
        wide = to_wide(named, features=bounded_values(named, "feature"))
        if lo is not None and hi is not None:
            wide = densify_wide(wide, "timestamp", lo, hi)
        safe = quote(region, safe="")  # one path per region, whatever its characters
        path = f"{out_dir}/{domain_prefix}_up/region={safe}"
        store.save_matrix(wide, path)
        outputs[region] = f"{path}.parquet"
    return outputs

"""Registry of named jobs: one per operator family of the blueprint.

Each job takes ``(spark, sf_dir)``, reads the driver tables through the
fixture views and returns a DataFrame (nothing is collected here except the
bounded values documented in the operators: pivot lists and scalar bounds).
Jobs that exercise stores write under the shared folder named by
``spark.checkpoint.dir`` and return what they read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymatrix.functions.clean import clean_label, day_of, has_text, pad_unit_code, region_label, visit_class, \
    visit_class_group
from daymatrix.functions.icd import SELECTED_CODES, icd_code3_prefix, icd_code3_search, icd_normalize, \
    icd_ordinal
from daymatrix.functions.names import with_feature
from daymatrix.operators.demand import DEMAND_VARIABLES, SCOPES, clean_visits, demand_counts, prepare_visits
from daymatrix.operators.diagnosis import LEVELS, code_daily, code_daily_by_region, daily_total, diagnosis_counts, \
    grouped_long, prepare_diagnoses, raw_code_rows
from daymatrix.operators.join import combine_long, join_daily, join_daily_long, merge_wide
from daymatrix.operators.dedup import data_id, latest_wins
from daymatrix.operators.lookup import unit_region_lookup
from daymatrix.operators import reports
from daymatrix.operators.quality import unknown_codes, unmatched_units
from daymatrix.operators.reshape import align_union, bounded_values, to_long, to_wide
from daymatrix.operators.timeseries import bounds, densify_long, densify_wide, fill_series, year_ranges
from daymatrix.plans import daily, monthly
from daymatrix.plans import features as names
from daymatrix.plans import incremental as inc
from daymatrix.schema import COUNT_KEY, VISIT_COLUMNS, require_columns, resolve_columns
from daymatrix.session import materialize, scratch_path, written
from daymatrix.sources import fixtures as fx
from daymatrix.sources import blocks, commits, scan, store
from daymatrix.sources.tables import read_table
from daymatrix.streaming.daily_counts import compact_daily_counts, read_daily_counts, run_daily_counts

# Fixed parameters of the registered jobs (dates inside the fixture spans).
SCAN_LO, SCAN_HI, SCAN_AFTER = dt.date(1998, 1, 1), dt.date(1999, 1, 1), dt.date(1998, 6, 30)
DIAG_SCAN_LO, DIAG_SCAN_HI = dt.date(1996, 1, 1), dt.date(1997, 1, 1)
MIN_VALID = dt.date(1996, 1, 1)
AS_OF = dt.date(2001, 11, 5)
BATCH1_END = dt.date(1999, 1, 1)      # batch 1: days before this
BATCH2_START = dt.date(1998, 12, 2)   # batch 2: days from this (30 days of overlap)
LATE_COLUMN = "demanda__TIPUS_CLASS__ZZ"   # a column that the first batch does not have
LOOKBACK_DAYS = 30
RETENTION_DAYS = 90
RECENT_FROM = dt.date(2001, 1, 1)
FUTURE = dt.date(2099, 1, 1)
LOADED = (dt.datetime(1999, 1, 1, 6), dt.datetime(2001, 11, 5, 6))   # when the two batches were appended
DELETED = (dt.date(1998, 12, 1), dt.date(1999, 1, 1))   # a month that the source loses
WRONG_MONTH = (dt.date(1995, 3, 1), dt.date(1995, 3, 31))   # counted wrongly by a first run
STAGING_RANGE = (dt.date(1998, 6, 1), dt.date(1999, 6, 30))
FINAL_RANGE = (dt.date(1997, 1, 1), dt.date(2000, 12, 31))
RECENT_FEATURES = ["DEMAND_demanda__TOTAL_CAT", "DIAGNOSIS_TOTAL"]

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def job(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# --- shared building blocks ---------------------------------------------------

def _prepared(spark, sf, lookup=None):
    return prepare_visits(fx.visits(spark, sf), lookup if lookup is not None else fx.up_rs(spark, sf))


def _reduced(spark, sf, lookup=None):
    return prepare_diagnoses(fx.diagnoses(spark, sf), lookup if lookup is not None else fx.up_rs(spark, sf))


def _demand(spark, sf, scopes=SCOPES, variables=DEMAND_VARIABLES, total=True, lookup=None):
    rows = fx.visits(spark, sf).count() if "UP" in scopes else None
    return demand_counts(_prepared(spark, sf, lookup), scopes, variables, total, rows)


def _diagnosis(spark, sf, scopes=SCOPES, levels=LEVELS, total=True, selected=SELECTED_CODES, lookup=None):
    return diagnosis_counts(_reduced(spark, sf, lookup), scopes, levels, total, selected)


def _named(long: DataFrame) -> DataFrame:
    return with_feature(long).select("day", "feature", "n")


def _demand_cat_named(spark, sf, lookup=None):
    return _named(_demand(spark, sf, ("CAT",), lookup=lookup))


def _diagnosis_cat_named(spark, sf, lookup=None):
    return _named(_diagnosis(spark, sf, ("CAT",), lookup=lookup))


def _both_cat_named(spark, sf):
    """Demand and diagnosis CAT counts sharing one lookup (probed once)."""
    lookup = fx.up_rs(spark, sf)
    return _demand_cat_named(spark, sf, lookup), _diagnosis_cat_named(spark, sf, lookup)


# --- sources and scans (S1-S6, T2) ----------------------------------------------

@job("scan_range")
def scan_range(spark, sf):
    return scan.scan_range(fx.visits(spark, sf), "DATA_VISITA", SCAN_LO, SCAN_HI,
                           ["DATA_VISITA", "UP", "SERVEI_CODI"])


@job("scan_after_watermark")
def scan_after_watermark(spark, sf):
    return scan.scan_range(fx.visits(spark, sf), "DATA_VISITA", SCAN_LO, SCAN_HI,
                           ["DATA_VISITA", "UP", "SERVEI_CODI"], after=SCAN_AFTER)


@job("scan_diagnosis_not_null")
def scan_diagnosis_not_null(spark, sf):
    d = fx.diagnoses(spark, sf)
    return scan.scan_not_null(d, "data_visita", DIAG_SCAN_LO, DIAG_SCAN_HI, "problema_salut_c").select(
        F.col("data_visita").alias("DATA_VISITA"), F.col("up_c").alias("UP"),
        F.col("problema_salut_c").alias("DIAG_CODE"))


@job("date_bounds")
def date_bounds(spark, sf):
    return scan.date_bounds(fx.visits(spark, sf), "DATA_VISITA", MIN_VALID, AS_OF)


@job("year_ranges")
def year_ranges_job(spark, sf):
    v = fx.visits(spark, sf)
    return year_ranges(v.select(day_of(v, "DATA_VISITA").alias("day")))


@job("lookup_up_rs")
def lookup_up_rs(spark, sf):
    """Normalised lookup as used: every listed unit, its region, its visits."""
    lk = unit_region_lookup(fx.up_rs(spark, sf))
    used = clean_visits(fx.visits(spark, sf)).groupBy("UP").agg(F.count(F.lit(1)).alias("n_visits"))
    return (lk.join(used, "UP", "left")
            .select("UP", region_label("RS").alias("RS"),
                    F.coalesce("n_visits", F.lit(0)).cast("long").alias("n_visits")))


@job("selected_codes")
def selected_codes(spark, sf):
    """The selected-code list with how many diagnoses carry each code."""
    codes = spark.createDataFrame([(c,) for c in sorted(set(SELECTED_CODES))], "ICD10_3 STRING")
    used = _reduced(spark, sf).groupBy("ICD10_3").agg(F.sum("n").alias("n"))
    return codes.join(used, "ICD10_3", "left").select(
        "ICD10_3", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


# --- cleaning (P1-P8) ---------------------------------------------------------

@job("pad_unit_code")
def pad_unit_code_job(spark, sf):
    v = fx.visits(spark, sf)
    return v.groupBy(F.col("UP").alias("UP_RAW")).agg(F.count(F.lit(1)).alias("n")).select(
        "UP_RAW", pad_unit_code("UP_RAW").alias("UP"), "n")


@job("clean_labels")
def clean_labels(spark, sf):
    v = fx.visits(spark, sf)
    return v.groupBy(
        clean_label("VISI_LLOC_VISITA").alias("VISI_LLOC_VISITA"),
        clean_label("VISI_SITUACIO_VISITA").alias("VISI_SITUACIO_VISITA"),
        clean_label("SERVEI_CODI").alias("SERVEI_CODI"),
    ).agg(F.count(F.lit(1)).alias("n"))


@job("visit_class")
def visit_class_job(spark, sf):
    v = fx.visits(spark, sf)
    return v.groupBy(F.col("TIPUS_CLASS").alias("TIPUS_CLASS_RAW"),
                     visit_class("TIPUS_CLASS").alias("TIPUS_CLASS")).agg(F.count(F.lit(1)).alias("n"))


@job("visit_class_group")
def visit_class_group_job(spark, sf):
    v = fx.visits(spark, sf)
    cls = visit_class("TIPUS_CLASS")
    return v.groupBy(cls.alias("TIPUS_CLASS"), visit_class_group(cls).alias("TIPUS_VISITA_AGRUPAT")).agg(
        F.count(F.lit(1)).alias("n"))


@job("region_default")
def region_default(spark, sf):
    return _prepared(spark, sf).groupBy("RS").agg(F.count(F.lit(1)).alias("n"))


@job("visits_by_day")
def visits_by_day(spark, sf):
    return clean_visits(fx.visits(spark, sf)).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@job("visits_with_region")
def visits_with_region(spark, sf):
    return _prepared(spark, sf).groupBy("UP", "RS").agg(F.count(F.lit(1)).alias("n"))


# --- ICD-10 (P9-P12, J4) ---------------------------------------------------------

def _diag_codes(spark, sf):
    return fx.diagnoses(spark, sf).select(F.col("problema_salut_c").alias("DIAG_CODE"))


@job("icd_normalize")
def icd_normalize_job(spark, sf):
    return _diag_codes(spark, sf).groupBy(
        "DIAG_CODE", icd_normalize("DIAG_CODE").alias("ICD10_CODE")).agg(F.count(F.lit(1)).alias("n"))


@job("icd_code3_search")
def icd_code3_search_job(spark, sf):
    return _diag_codes(spark, sf).groupBy(
        "DIAG_CODE", icd_code3_search("DIAG_CODE").alias("ICD10_3")).agg(F.count(F.lit(1)).alias("n"))


@job("icd_code3_prefix")
def icd_code3_prefix_job(spark, sf):
    return _diag_codes(spark, sf).groupBy(
        "DIAG_CODE", icd_code3_prefix("DIAG_CODE").alias("ICD10_3")).agg(F.count(F.lit(1)).alias("n"))


@job("icd_ordinal")
def icd_ordinal_job(spark, sf):
    code3 = icd_code3_search("DIAG_CODE")
    return _diag_codes(spark, sf).groupBy(code3.alias("ICD10_3"), icd_ordinal(code3).alias("ordinal")).agg(
        F.count(F.lit(1)).alias("n"))


@job("icd_chapter")
def icd_chapter_job(spark, sf):
    return _reduced(spark, sf).groupBy("ICD10_3", "ICD10_CHAPTER").agg(F.sum("n").cast("long").alias("n"))


@job("icd_subchapter")
def icd_subchapter_job(spark, sf):
    return _reduced(spark, sf).groupBy("ICD10_3", "ICD10_SUBCHAPTER").agg(F.sum("n").cast("long").alias("n"))


# --- demand counts (A1-A5, P14, P15) ------------------------------------------

@job("demand_total_cat")
def demand_total_cat(spark, sf):
    return _demand(spark, sf, ("CAT",), [], True)


@job("demand_total_rs")
def demand_total_rs(spark, sf):
    return _demand(spark, sf, ("RS",), [], True)


@job("demand_total_up")
def demand_total_up(spark, sf):
    return _demand(spark, sf, ("UP",), [], True)


@job("demand_features_cat")
def demand_features_cat(spark, sf):
    return _demand(spark, sf, ("CAT",), DEMAND_VARIABLES, False)


@job("demand_features_rs")
def demand_features_rs(spark, sf):
    return _demand(spark, sf, ("RS",), DEMAND_VARIABLES, False)


@job("demand_features_up")
def demand_features_up(spark, sf):
    return _demand(spark, sf, ("UP",), DEMAND_VARIABLES, False)


@job("demand_all_scopes")
def demand_all_scopes(spark, sf):
    return _demand(spark, sf)


@job("demand_feature_names")
def demand_feature_names(spark, sf):
    return _named(_demand(spark, sf))


# --- wide renderings (R1-R8) -------------------------------------------------------

@job("demand_wide_cat")
def demand_wide_cat(spark, sf):
    return to_wide(_demand_cat_named(spark, sf), features=names.demand_features("CAT"))


@job("demand_wide_rs")
def demand_wide_rs(spark, sf):
    return to_wide(_named(_demand(spark, sf, ("RS",))), features=names.demand_features("RS"))


@job("wide_to_long")
def wide_to_long(spark, sf):
    return to_long(demand_wide_cat(spark, sf))


# --- diagnosis (A6-A11, F2, F3, R3-R6) ------------------------------------------

@job("diagnosis_prepared")
def diagnosis_prepared(spark, sf):
    return _reduced(spark, sf)


@job("diagnosis_total")
def diagnosis_total(spark, sf):
    return daily_total(_reduced(spark, sf))


@job("diagnosis_total_rs")
def diagnosis_total_rs(spark, sf):
    return reports.total_by_group(_reduced(spark, sf), features=[f"DIAG_TOTAL__RS__{r}" for r in sorted(names.DIAGNOSIS_REGIONS)])


@job("diagnosis_code_daily")
def diagnosis_code_daily(spark, sf):
    return code_daily(raw_code_rows(fx.diagnoses(spark, sf)))


@job("diagnosis_code_by_group")
def diagnosis_code_by_group(spark, sf):
    raw = fx.diagnoses(spark, sf)
    return code_daily_by_region(raw_code_rows(raw), fx.up_rs(spark, sf), n_rows=raw.count())


@job("diagnosis_feature_names")
def diagnosis_feature_names(spark, sf):
    return _named(_diagnosis(spark, sf))


@job("selected_raw_codes")
def selected_raw_codes(spark, sf):
    rows = raw_code_rows(fx.diagnoses(spark, sf), selected_codes=SELECTED_CODES)
    return code_daily(rows)


@job("grouped_long_chapter_cat")
def grouped_long_chapter_cat(spark, sf):
    return grouped_long(_reduced(spark, sf), "ICD10_CHAPTER")


@job("grouped_long_subchapter_rs")
def grouped_long_subchapter_rs(spark, sf):
    return grouped_long(_reduced(spark, sf), "ICD10_SUBCHAPTER", "RS")


@job("grouped_long_code_up")
def grouped_long_code_up(spark, sf):
    return grouped_long(_reduced(spark, sf), "ICD10_3", "UP")


@job("wide_chapter_cat")
def wide_chapter_cat(spark, sf):
    return to_wide(_named(_diagnosis(spark, sf, ("CAT",), ["ICD10_CHAPTER"], False, None)),
                   features=names.diagnosis_features("CAT", ["ICD10_CHAPTER"], False))


@job("wide_chapter_rs")
def wide_chapter_rs(spark, sf):
    return to_wide(_named(_diagnosis(spark, sf, ("RS",), ["ICD10_CHAPTER"], False, None)),
                   features=names.diagnosis_features("RS", ["ICD10_CHAPTER"], False))


@job("diagnosis_code_wide")
def diagnosis_code_wide(spark, sf):
    long = diagnosis_counts(_reduced(spark, sf), ("CAT",), ["ICD10_3"], False, SELECTED_CODES)
    return to_wide(long.select("day", F.concat(F.lit("DIAG_CODE_"), "value").alias("feature"), "n"),
                   features=[f"DIAG_CODE_{c}" for c in sorted(set(SELECTED_CODES))])


@job("diagnosis_code_blocks")
def diagnosis_code_blocks(spark, sf):
    """Every 3-character code on every day (R6), written in blocks of columns;
    the non-zero cells of all blocks read back."""
    long = diagnosis_counts(_reduced(spark, sf), ("CAT",), ["ICD10_3"], False, None)
    path = scratch_path(spark, "code-blocks")
    blocks = store.write_wide_blocks(long.select("day", F.concat(F.lit("DIAG_CODE_"), "value").alias("feature"), "n"), path)
    rows = [to_long(spark.read.parquet(b)).where("n <> 0") for b in blocks]
    return combine_long(rows)


@job("raw_code_blocks")
def raw_code_blocks(spark, sf):
    """Every raw code on every day (R6), whole codes, in blocks of columns; the
    cells that are not 0 read back."""
    long = code_daily(raw_code_rows(fx.diagnoses(spark, sf))).select(
        F.lit("raw").alias("matrix"), "day", F.concat(F.lit("DIAG_CODE_"), "DIAG_CODE").alias("feature"), "n")
    long = written(long, "raw-codes")
    path = blocks.write_blocks(long, [bounds(long, "day")], scratch_path(spark, "raw-code-blocks"))
    return blocks.read_long(spark, path).drop("matrix")


def _up_blocks(spark, sf, counts, lookup):
    path = scratch_path(spark, "up-blocks")
    return blocks.column_digests(spark, daily.write_up_blocks(written(counts, "up-counts"), lookup, path))


@job("up_blocks_demand")
def up_blocks_demand(spark, sf):
    """The dense UP matrices of demand (I8), one a region, written in blocks;
    every column's days, cells, sum and sum by day number from the files."""
    lookup = fx.up_rs(spark, sf)
    return _up_blocks(spark, sf, _demand(spark, sf, ("UP",), lookup=lookup), lookup)


@job("up_blocks_diagnosis")
def up_blocks_diagnosis(spark, sf):
    """As ``up_blocks_demand`` for diagnoses."""
    lookup = fx.up_rs(spark, sf)
    return _up_blocks(spark, sf, _diagnosis(spark, sf, ("UP",), lookup=lookup), lookup)


def _selected_matrix(spark, sf, scope):
    long = diagnosis_counts(_reduced(spark, sf), (scope,), ["ICD10_3"], False, SELECTED_CODES)
    columns = [f"ICD10_3__{c}" for c in sorted(set(SELECTED_CODES))] if scope == "CAT" else \
        names.diagnosis_features(scope, ["ICD10_3"], False)
    return reports.selected_matrix(long, scope, columns)


@job("selected_daily_cat")
def selected_daily_cat(spark, sf):
    return _selected_matrix(spark, sf, "CAT")


@job("selected_daily_rs")
def selected_daily_rs(spark, sf):
    return _selected_matrix(spark, sf, "RS")


@job("selected_wide_cat")
def selected_wide_cat(spark, sf):
    return to_wide(_diagnosis_cat_named(spark, sf), features=names.diagnosis_features("CAT"))


@job("selected_wide_rs")
def selected_wide_rs(spark, sf):
    return to_wide(_named(_diagnosis(spark, sf, ("RS",))), features=names.diagnosis_features("RS"))


@job("selected_long_up")
def selected_long_up(spark, sf):
    return _named(_diagnosis(spark, sf, ("UP",)))


# --- time series (T1-T6) ----------------------------------------------------------

@job("densify_total_cat")
def densify_total_cat(spark, sf):
    long = materialize(_named(_demand(spark, sf, ("CAT",), [], True)))  # read by three jobs below
    lo, hi = bounds(long, "day")
    return densify_wide(to_wide(long, features=bounded_values(long, "feature")), "timestamp", lo, hi)


@job("densify_features_rs")
def densify_features_rs(spark, sf):
    return densify_long(_named(_demand(spark, sf, ("RS",))), ["feature"], "day", "n")


def _sparse_chapters(spark, sf):
    long = _named(_diagnosis(spark, sf, ("CAT",), ["ICD10_CHAPTER"], False, None))
    return densify_long(long, ["feature"], "day", "n", fill=None)


@job("fill_forward")
def fill_forward(spark, sf):
    return fill_series(_sparse_chapters(spark, sf), ["feature"], "day", "n", "ffill")


@job("fill_backward")
def fill_backward(spark, sf):
    return fill_series(_sparse_chapters(spark, sf), ["feature"], "day", "n", "bfill")


@job("fill_interpolate")
def fill_interpolate(spark, sf):
    return fill_series(_sparse_chapters(spark, sf), ["feature"], "day", "n", "interpolate")


# --- joins (J5-J9, Q3, Q4, F7, A15) -------------------------------------------------

def _joined_long(spark, sf, fill="ffill"):
    return join_daily_long(*_both_cat_named(spark, sf), ("DEMAND", "DIAGNOSIS"), fill)


@job("joined_daily")
def joined_daily(spark, sf):
    return join_daily(*_both_cat_named(spark, sf), features=names.joined_features())


@job("historical_all")
def historical_all(spark, sf):
    """The six matrices (demand and diagnosis x CAT/RS/UP) combined, in long
    form: one row per non-zero cell (J6)."""
    lookup = fx.up_rs(spark, sf)
    return combine_long([_named(_demand(spark, sf, lookup=lookup)), _named(_diagnosis(spark, sf, lookup=lookup))])


@job("historical_blocks")
def historical_blocks(spark, sf):
    """The six matrices side by side, dense and zero-filled (J6, Q4, S16), as
    columns' days, cells, sum and sum by day number from the files."""
    lookup = fx.up_rs(spark, sf)
    paths = [scratch_path(spark, "history-long") for _ in range(2)]
    for counts, path in zip((_demand(spark, sf, lookup=lookup), _diagnosis(spark, sf, lookup=lookup)), paths):
        store.save_final(counts.hint("rebalance", "scope", "variable"), path, partition_by=["scope", "variable"])
    return blocks.column_digests(spark, daily.historical_blocks(spark, paths, scratch_path(spark, "history-blocks")))


def _batched(df: DataFrame, day_col: str) -> tuple[DataFrame, DataFrame]:
    """The two fixture batches, cut by day with 30 days of overlap."""
    return (df.where(F.col(day_col) < F.lit(BATCH1_END)),
            df.where(F.col(day_col) >= F.lit(BATCH2_START)))


def _wide_batches(spark, sf, long_fn, columns: list[str]) -> DataFrame:
    """Write each batch's own wide matrix as a staging batch; read all back.
    The first batch lacks one column, so the two differ (U1)."""
    path = scratch_path(spark, "wide-staging")
    long = written(long_fn(spark, sf), "wide-batches")
    first, second = _batched(long, "day")
    store.append_batch(to_wide(first, features=[c for c in columns if c != LATE_COLUMN], subset=True), path, batch_id=1)
    store.append_batch(to_wide(second, features=columns), path, batch_id=2)
    return store.read_staging(spark, path)


def _wide_staging_pair(spark, sf):
    """Demand CAT and diagnosis chapter wide batches, the two sides built
    from separate driver threads (independent jobs)."""
    lookup = fx.up_rs(spark, sf)
    with ThreadPoolExecutor(max_workers=2) as pool:
        demand = pool.submit(_wide_batches, spark, sf, lambda s, d: _demand_cat_named(s, d, lookup),
                             names.demand_features("CAT"))
        diag = pool.submit(_wide_batches, spark, sf, lambda s, d: _named(
            _diagnosis(s, d, ("CAT",), ["ICD10_CHAPTER"], True, None, lookup=lookup)),
            names.diagnosis_features("CAT", ["ICD10_CHAPTER"]))
        return demand.result(), diag.result()


@job("merge_finals")
def merge_finals(spark, sf):
    demand, diag = _wide_staging_pair(spark, sf)
    return merge_wide(demand, diag, ["timestamp"], None, "DIAG", store.BATCH_COL)


@job("merge_staging")
def merge_staging(spark, sf):
    demand, diag = _wide_staging_pair(spark, sf)
    return merge_wide(demand, diag, ["timestamp"], "DEMAND", "DIAGNOSIS", store.BATCH_COL)


@job("final_recent")
def final_recent(spark, sf):
    return reports.recent(_joined_long(spark, sf), RECENT_FROM, RECENT_FEATURES)


@job("monthly_trend")
def monthly_trend(spark, sf):
    return reports.monthly_totals(_joined_long(spark, sf))


@job("range_totals")
def range_totals(spark, sf):
    return reports.range_totals(_joined_long(spark, sf), *FINAL_RANGE)


# --- staging store, dedup, retention (D1, S10-S14, A12-A14, I5-I7, P20) --------------

def _staged_reduced(spark, sf) -> str:
    """Reduced diagnoses written as two overlapping staging batches."""
    path = scratch_path(spark, "staging")
    reduced = written(_reduced(spark, sf), "reduced")  # computed once, cut into the two batches
    for i, part in enumerate(_batched(reduced, "DATA_VISITA"), start=1):
        store.append_batch(part, path, batch_id=i, loaded_at=LOADED[i - 1], ts_col="DATA_VISITA")
    return path


REDUCED_KEY = ["DATA_VISITA", "ICD10_3", "UP"]


@job("dedup_latest")
def dedup_latest(spark, sf):
    long = _demand(spark, sf, ("CAT",))
    b1, b2 = _batched(long, "day")
    # Batch 2 holds two rows for each key, with changed counts; its second wins.
    both = b1.select("*", F.lit(1).alias("batch_seq"), F.lit(0).alias("row_seq")).unionByName(
        b2.select("*", F.lit(2).alias("batch_seq"), F.explode(F.array(F.lit(0), F.lit(1))).alias("row_seq"))
        .withColumn("n", F.col("n") * 10 + F.col("row_seq")))
    return latest_wins(both, COUNT_KEY, ["batch_seq", "row_seq"]).drop("batch_seq", "row_seq")


@job("load_staging")
def load_staging(spark, sf):
    return store.load_staging(spark, _staged_reduced(spark, sf), REDUCED_KEY)


@job("staging_range")
def staging_range(spark, sf):
    staged = store.load_staging(spark, _staged_reduced(spark, sf), REDUCED_KEY)
    lo, hi = STAGING_RANGE
    return staged.where(F.col("DATA_VISITA").between(F.lit(lo), F.lit(hi)))


@job("staging_to_final")
def staging_to_final(spark, sf):
    final_path = scratch_path(spark, "final")
    store.staging_to_final(spark, _staged_reduced(spark, sf), final_path, REDUCED_KEY, "DATA_VISITA", *FINAL_RANGE)
    return spark.read.parquet(final_path)


@job("staging_manifest")
def staging_manifest(spark, sf):
    return store.stored_manifest(spark, _staged_reduced(spark, sf), "DATA_VISITA")


@job("retention_keep")
def retention_keep(spark, sf):
    man = store.stored_manifest(spark, _staged_reduced(spark, sf), "DATA_VISITA")
    return store.retention_flags(man, AS_OF, RETENTION_DAYS).select("batch_id", "max_timestamp", "keep")


@job("last_date_in_finals")
def last_date_in_finals(spark, sf):
    demand_path, diag_path = scratch_path(spark, "final-demand"), scratch_path(spark, "final-diagnosis")
    demand, diagnosis = _both_cat_named(spark, sf)
    store.save_final(to_wide(demand, features=names.demand_features("CAT")), demand_path)
    store.save_final(to_wide(diagnosis, features=names.diagnosis_features("CAT")), diag_path)
    return reports.last_valid_date([spark.read.parquet(demand_path), spark.read.parquet(diag_path)],
                                   dt.date(1992, 1, 1), AS_OF + dt.timedelta(days=1))


@job("stored_bounds")
def stored_bounds(spark, sf):
    """First and last day of the stored final matrices, from their footers."""
    path = scratch_path(spark, "final-bounds")
    store.save_final(to_wide(_demand_cat_named(spark, sf), features=names.demand_features("CAT")), path)
    return scan.stored_bounds(spark, path, "timestamp", dt.date(1992, 1, 1), dt.date(2100, 1, 1))


@job("batch_reduce")
def batch_reduce(spark, sf):
    keys = ["DATA_VISITA", "RS", "ICD10_CHAPTER"]
    path = scratch_path(spark, "batch")
    reduced = _reduced(spark, sf).groupBy(*keys).agg(F.sum("n").cast("long").alias("n"))
    store.append_batch(reduced, path)
    return store.read_staging(spark, path).drop(store.BATCH_COL)


@job("narrow_types")
def narrow_types(spark, sf):
    return store.narrow_report(demand_wide_cat(spark, sf))


# --- incremental runs (I1, I2, I4) ------------------------------------------------

def _demand_counts_from(spark, sf):
    lookup = fx.up_rs(spark, sf)
    return lambda rows: demand_counts(prepare_visits(rows, lookup), rows=rows.count())


def _diagnosis_counts_from(spark, sf):
    lookup = fx.up_rs(spark, sf)
    return lambda rows: diagnosis_counts(prepare_diagnoses(rows, lookup), selected_codes=SELECTED_CODES)


@job("incremental_two_batches")
def incremental_two_batches(spark, sf):
    path = scratch_path(spark, "demand-store")
    src = fx.visits(spark, sf)
    build = _demand_counts_from(spark, sf)
    inc.run_recount(src, "DATA_VISITA", build, path, BATCH1_END - dt.timedelta(days=1), LOOKBACK_DAYS)
    inc.run_recount(src, "DATA_VISITA", build, path, AS_OF, LOOKBACK_DAYS)
    return inc.read_recount_store(spark, path)


@job("incremental_interrupted")
def incremental_interrupted(spark, sf):
    """Two runs, of which the second ends right after its record, before its
    months are moved: the store reads as if it had gone on (I1, I3)."""
    path = scratch_path(spark, "demand-store")
    src = fx.visits(spark, sf)
    build = _demand_counts_from(spark, sf)
    inc.run_recount(src, "DATA_VISITA", build, path, BATCH1_END - dt.timedelta(days=1), LOOKBACK_DAYS)
    inc.stage_recount(src, "DATA_VISITA", build, path, AS_OF, LOOKBACK_DAYS)
    return inc.read_recount_store(spark, path)


@job("recorded_watermark")
def recorded_watermark(spark, sf):
    """The watermark recorded with the data, of a run that ended before its
    months were moved, and the last day of the store that the next one finds."""
    path = scratch_path(spark, "diagnosis-store")
    src, build = fx.diagnoses(spark, sf), _diagnosis_counts_from(spark, sf)
    inc.run_recount(src, "data_visita", build, path, BATCH1_END - dt.timedelta(days=1), LOOKBACK_DAYS)
    inc.stage_recount(src, "data_visita", build, path, AS_OF, LOOKBACK_DAYS, run_at=LOADED[1])
    recorded = inc.load_run_state(spark, path).last_loaded_date
    inc.apply_pending(spark, path)
    return spark.createDataFrame([(recorded, inc.stored_hwm(spark, path))], "recorded DATE, stored DATE")


@job("incremental_diagnosis_two_batches")
def incremental_diagnosis_two_batches(spark, sf):
    path = scratch_path(spark, "diagnosis-store")
    src = fx.diagnoses(spark, sf)
    build = _diagnosis_counts_from(spark, sf)
    inc.run_recount(src, "data_visita", build, path, BATCH1_END - dt.timedelta(days=1), LOOKBACK_DAYS)
    inc.run_recount(src, "data_visita", build, path, AS_OF, LOOKBACK_DAYS)
    return inc.read_recount_store(spark, path)


@job("incremental_future_row")
def incremental_future_row(spark, sf):
    """Some visits of the first load carry a date after the run's day: they
    are not counted and later runs still load every day (X13)."""
    path = scratch_path(spark, "demand-store")
    src = fx.visits(spark, sf)
    build = _demand_counts_from(spark, sf)
    wrong = src.withColumn("DATA_VISITA", F.when(F.col("SERVEI_CODI") == "5-LOW", F.lit(FUTURE).cast(src.schema["DATA_VISITA"].dataType))
                           .otherwise(F.col("DATA_VISITA")))
    inc.run_recount(src.unionByName(wrong.where(F.col("DATA_VISITA") == F.lit(FUTURE))), "DATA_VISITA", build, path,
                    BATCH1_END - dt.timedelta(days=1), LOOKBACK_DAYS)
    inc.run_recount(src, "DATA_VISITA", build, path, AS_OF, LOOKBACK_DAYS)
    return inc.read_recount_store(spark, path)


@job("incremental_deleted_day")
def incremental_deleted_day(spark, sf):
    """The last month of the first load loses all its visits at the source
    before the second run: its counts go from the store."""
    path = scratch_path(spark, "demand-store")
    src = fx.visits(spark, sf)
    build = _demand_counts_from(spark, sf)
    inc.run_recount(src, "DATA_VISITA", build, path, BATCH1_END - dt.timedelta(days=1), LOOKBACK_DAYS)
    left = src.where((F.col("DATA_VISITA") < F.lit(DELETED[0])) | (F.col("DATA_VISITA") >= F.lit(DELETED[1])))
    inc.run_recount(left, "DATA_VISITA", build, path, AS_OF, LOOKBACK_DAYS)
    return inc.read_recount_store(spark, path)


@job("incremental_add")
def incremental_add(spark, sf):
    path = scratch_path(spark, "additive-store")
    counts = _demand(spark, sf)
    inc.add_disjoint_batch(counts.where(F.col("day") < F.lit(BATCH1_END)), path)
    inc.add_disjoint_batch(counts.where(F.col("day") >= F.lit(BATCH1_END)), path)
    return inc.read_additive_store(spark, path)


@job("filled_months_redone")
def filled_months_redone(spark, sf):
    """Chapter series filled forward, kept by month over three runs: days up to
    the first batch's end with wrong counts in one month, that month put right,
    and the rest of the days. Equal to the full build."""
    path = scratch_path(spark, "filled-months")
    counts = written(_named(_diagnosis(spark, sf, ("CAT",), ["ICD10_CHAPTER"], False, None)), "chapter-counts")
    lo, hi = WRONG_MONTH
    early = counts.where(F.col("day") < F.lit(BATCH1_END))
    wrong = F.col("day").between(F.lit(lo), F.lit(hi))
    monthly.update(early.withColumn("n", F.when(wrong, F.col("n") * 2).otherwise(F.col("n"))).where(~wrong | (F.dayofmonth("day") < 20)), path)
    monthly.update(early, path, lo, hi)
    monthly.update(counts, path, BATCH1_END)
    return monthly.read_filled(spark, path)


# --- quality (V3, V4) ----------------------------------------------------------------

@job("unknown_codes_report")
def unknown_codes_report(spark, sf):
    return unknown_codes(fx.diagnoses(spark, sf))


@job("unknown_units")
def unknown_units(spark, sf):
    raw = fx.diagnoses(spark, sf)
    rows = raw_code_rows(raw.where(has_text("up_c")))  # rows with a unit
    return unmatched_units(rows, fx.up_rs(spark, sf))


# --- streaming (I10) ----------------------------------------------------------------

@job("stream_daily_counts")
def stream_daily_counts(spark, sf):
    source = f"{sf.rstrip('/')}/events*.parquet"   # the table's files
    schema = read_table(spark, sf, "events").schema
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    return run_daily_counts(spark, source, schema, sink, ckpt)


@job("stream_late_rows")
def stream_late_rows(spark, sf):
    """The events in several micro-batches that each span all days, so most
    rows arrive days late: none may be lost."""
    events = fx.events(spark, sf)
    source = scratch_path(spark, "stream-source")
    events.repartition(4, "user_id").write.parquet(source)
    return run_daily_counts(spark, source, events.schema, scratch_path(spark, "stream-sink"),
                            scratch_path(spark, "stream-ckpt"), max_files_per_trigger=1)


@job("stream_compacted")
def stream_compacted(spark, sf):
    """The stream in two runs of several micro-batches each, compacted within
    the first run, between the two and after them: every event counts once."""
    events = fx.events(spark, sf)
    source, sink, ckpt = (scratch_path(spark, n) for n in ("stream-source", "stream-sink", "stream-ckpt"))
    for part in range(2):
        events.where(F.pmod(F.col("event_id"), F.lit(2)) == part).repartition(4, "user_id").write.mode("append").parquet(source)
        run_daily_counts(spark, source, events.schema, sink, ckpt, max_files_per_trigger=1, compact_every=3 if part == 0 else None)
        compact_daily_counts(spark, sink)
    return read_daily_counts(spark, sink)


# --- stores and checks as write-then-read jobs (S7-S9, S13, S15, P18-P20, V1, V2, V5, I3, I7, R7) ----

def _total_long(spark, sf):
    return _named(_demand(spark, sf, ("CAT",), ["SERVEI_CODI"], True))


def _total_wide(spark, sf):
    wanted = [c for c in names.demand_features("CAT") if "TOTAL" in c or "SERVEI" in c]
    return to_wide(_total_long(spark, sf), features=wanted)


@job("matrix_csv_round_trip")
def matrix_csv_round_trip(spark, sf):
    """Headed CSV written, read back and coerced to counts."""
    path = scratch_path(spark, "matrix-csv")
    store.save_matrix_csv(_total_wide(spark, sf), path)
    return store.load_matrix_csv(spark, path)


@job("matrix_dual_write")
def matrix_dual_write(spark, sf):
    """Parquet and CSV of one matrix; both must hold the same cells."""
    path = scratch_path(spark, "matrix")
    store.save_matrix(_total_wide(spark, sf), path)
    parquet = to_long(spark.read.parquet(f"{path}.parquet")).withColumn("kind", F.lit("parquet"))
    return parquet.unionByName(to_long(store.load_matrix_csv(spark, f"{path}.csv")).withColumn("kind", F.lit("csv")))


@job("long_partitioned_store")
def long_partitioned_store(spark, sf):
    """Counts stored by scope and variable, one scope read back."""
    path = scratch_path(spark, "long-store")
    store.save_final(_demand(spark, sf, ("CAT", "RS")).hint("rebalance", "scope", "variable"), path, partition_by=["scope", "variable"])
    return spark.read.parquet(path).where("scope = 'RS'").select("day", "group_value", "variable", "value", "n")


@job("data_ids")
def data_ids(spark, sf):
    """One text id per key; distinct keys have distinct ids."""
    reduced = _reduced(spark, sf)
    return reduced.select(data_id("DATA_VISITA", "ICD10_3", "UP").alias("data_id"), "n")


@job("narrow_casts")
def narrow_casts(spark, sf):
    """P20: columns cast to their narrowest types keep their values."""
    return to_long(store.narrow_types(_total_wide(spark, sf)).select(
        "timestamp", *[F.col(f"`{c}`").cast("long").alias(c) for c in [c for c in names.demand_features("CAT") if "TOTAL" in c or "SERVEI" in c]]))


@job("state_watermark")
def state_watermark(spark, sf):
    """The watermark of two runs, the second of which goes by the first's
    record; loaded back."""
    visits, lookup = fx.visits(spark, sf), fx.up_rs(spark, sf)
    counts, state = scratch_path(spark, "demand-store"), scratch_path(spark, "state")
    for as_of in (BATCH1_END - dt.timedelta(days=1), AS_OF):
        daily.run_demand_increment(visits, lookup, counts, as_of, LOOKBACK_DAYS, state_path=state, run_at=LOADED[1])
    return spark.createDataFrame([(store.load_state(spark, state),)], "last_loaded_date DATE")


@job("required_columns")
def required_columns(spark, sf):
    """V1, V2: the needed columns found whatever their case, with the rows that
    have a value in each."""
    visits = fx.visits(spark, sf)
    other = visits.toDF(*[c.lower() if i % 2 else c.title() for i, c in enumerate(visits.columns)])
    found = resolve_columns(other, VISIT_COLUMNS)
    renamed = other.select(*[F.col(found[c]).alias(c) for c in VISIT_COLUMNS])
    require_columns(renamed, VISIT_COLUMNS)
    return renamed.select(*[F.count(c).alias(c) for c in VISIT_COLUMNS]).unpivot([], VISIT_COLUMNS, "column_name", "n")


@job("staging_skip_unreadable")
def staging_skip_unreadable(spark, sf):
    """The batches' rows while one of their folders holds a broken file."""
    path = _staged_reduced(spark, sf)
    commits.write_new(spark, f"{path}/{store.BATCH_COL}=2/part-broken.snappy.parquet", "not a Parquet file " * 100)
    return store.read_staging(spark, path, ignore_corrupt=True)


@job("diagnosis_final_build")
def diagnosis_final_build(spark, sf):
    """The whole final build of diagnoses; the cells that are not 0 of its
    three matrices, as stored."""
    out = daily.diagnosis_final(spark, fx.diagnoses(spark, sf), fx.up_rs(spark, sf), scratch_path(spark, "final-build"), up_matrices=True)
    cells = [to_long(spark.read.parquet(out[f"diagnosis_{s}"])).withColumn("scope", F.lit(s.upper())) for s in ("cat", "rs")]
    cells.append(blocks.read_long(spark, out["diagnosis_up"]).drop("matrix").withColumn("scope", F.lit("UP")))
    return combine_long(cells).where("n <> 0")


@job("historical_file")
def historical_file(spark, sf):
    """The six matrices written as one combined file, read back."""
    lookup = fx.up_rs(spark, sf)
    paths = [scratch_path(spark, "history-long") for _ in range(2)]
    for counts, path in zip((_demand(spark, sf, lookup=lookup), _diagnosis(spark, sf, lookup=lookup)), paths):
        store.save_final(counts, path)
    return spark.read.parquet(daily.historical_combined(spark, paths, scratch_path(spark, "history")))


@job("compact_staging_batches")
def compact_staging_batches(spark, sf):
    """Batches rewritten as one, the latest row per key."""
    path = _staged_reduced(spark, sf)
    store.compact_staging(spark, path, REDUCED_KEY)
    return store.read_staging(spark, path).drop(store.BATCH_COL)


@job("aligned_matrices")
def aligned_matrices(spark, sf):
    """Matrices with different columns, unioned with 0 fill."""
    wide = _total_wide(spark, sf)
    early = wide.where(F.col("timestamp") < F.lit(BATCH1_END)).drop("demanda__TOTAL_CAT")
    late = wide.where(F.col("timestamp") >= F.lit(BATCH1_END)).drop("demanda__SERVEI_CODI__5-LOW")
    return align_union([early, late])

"""End-to-end jobs, renderings and store helpers on sf0.001."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymatrix.operators.demand import demand_counts, prepare_visits
from daymatrix.operators.reshape import TooManyColumnsError, to_long, to_wide
from daymatrix.plans import daily
from daymatrix.schema import MissingColumnsError, require_columns, resolve_columns
from daymatrix.session import scratch_path
from daymatrix.sources import fixtures as fx
from daymatrix.sources import store

from conftest import SF_SMALL


def test_demand_final_outputs(spark):
    out_dir = scratch_path(spark, "t-demand-final")
    paths = daily.demand_final(spark, fx.visits(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL), out_dir)
    cat = spark.read.parquet(paths["demand_cat"])
    lo, hi = cat.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert cat.count() == (hi - lo).days + 1          # dense calendar
    rs = spark.read.parquet(paths["demand_rs"])
    rs_total = sum(F.col(f"`{c}`") for c in rs.columns if c.startswith("demanda__TOTAL_RS_"))
    joined = cat.join(rs.select("timestamp", rs_total.alias("rs_sum")), "timestamp")
    assert joined.where(F.col("`demanda__TOTAL_CAT`") != F.col("rs_sum")).count() == 0
    csv = store.load_matrix_csv(spark, f"{out_dir}/demand_cat.csv")
    assert sorted(csv.collect()) == sorted(cat.collect())
    long = spark.read.parquet(paths["demand_long"])
    assert {r.scope for r in long.select("scope").distinct().collect()} == {"CAT", "RS", "UP"}


def test_diagnosis_final_nine_datasets(spark):
    out_dir = scratch_path(spark, "t-diag-final")
    paths = daily.diagnosis_final(spark, fx.diagnoses(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL), out_dir)
    long = spark.read.parquet(paths["diagnosis_long"])
    parts = {(r.scope, r.variable) for r in long.select("scope", "variable").distinct().collect()}
    assert {(s, v) for s in ("CAT", "RS", "UP") for v in ("ICD10_CHAPTER", "ICD10_SUBCHAPTER", "ICD10_3")} <= parts
    cat = spark.read.parquet(paths["diagnosis_cat"])
    assert "TOTAL" in cat.columns and any(c.startswith("CHAPTER_") for c in cat.columns)


def test_historical_requires_inputs(spark):
    with pytest.raises(daily.MissingInputError):
        daily.historical_combined(spark, [scratch_path(spark, "nope")], scratch_path(spark, "t-hist"))


def test_joined_final_and_historical(spark):
    out_dir = scratch_path(spark, "t-joined")
    d = daily.demand_final(spark, fx.visits(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL), out_dir)
    g = daily.diagnosis_final(spark, fx.diagnoses(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL), out_dir)
    dem, dia = spark.read.parquet(d["demand_long"]), spark.read.parquet(g["diagnosis_long"])
    joined = spark.read.parquet(daily.joined_final(spark, dem, dia, f"{out_dir}/joined"))
    assert joined.where(F.col("`DEMAND_demanda__TOTAL_CAT`").isNull()).count() == 0
    hist = spark.read.parquet(daily.historical_combined(spark, [d["demand_long"], g["diagnosis_long"]],
                                                         f"{out_dir}/hist"))
    assert hist.count() == dem.count() + dia.count()


def test_wide_long_roundtrip_and_cap(spark):
    counts = demand_counts(prepare_visits(fx.visits(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL)), ("CAT",))
    named = counts.select("day", F.concat_ws("__", "variable", "value").alias("feature"), "n")
    wide = to_wide(named)
    back = to_wide(to_long(wide).withColumnRenamed("timestamp", "day"))
    assert sorted(back.collect()) == sorted(wide.collect())
    with pytest.raises(TooManyColumnsError):
        to_wide(named, cap=3)


def test_state_and_compaction(spark):
    path = scratch_path(spark, "t-state")
    assert store.load_state(spark, path) is None
    store.save_state(spark, path, dt.date(2001, 8, 1), dt.datetime(2001, 8, 2, 6, 0))
    assert store.load_state(spark, path) == dt.date(2001, 8, 1)
    stg = scratch_path(spark, "t-compact")
    store.append_batch(spark.createDataFrame([("a", 1), ("b", 1)], "k STRING, n INT"), stg)
    store.append_batch(spark.createDataFrame([("a", 2)], "k STRING, n INT"), stg)
    assert store.compact_staging(spark, stg, ["k"]) == 3
    rows = store.read_staging(spark, stg).collect()
    assert sorted((r.k, r.n, r.batch_id) for r in rows) == [("a", 2, 3), ("b", 1, 3)]


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], "Data_Visita INT, up INT")
    with pytest.raises(MissingColumnsError, match=r"\['DATA_VISITA', 'UP'\]"):
        require_columns(df, ["UP", "DATA_VISITA"])
    assert resolve_columns(df, ["data_visita", "UP"]) == {"data_visita": "Data_Visita", "UP": "up"}
    with pytest.raises(MissingColumnsError, match="available"):
        resolve_columns(df, ["DIAG_CODE"])


def test_matrix_csv_bad_cells(spark):
    path = scratch_path(spark, "t-csv")
    spark.createDataFrame([("2024-01-01", "3", "x")], "Timestamp STRING, a STRING, b STRING") \
        .write.option("header", True).csv(path)
    row = store.load_matrix_csv(spark, path).first()
    assert (row.timestamp, row.a, row.b) == (dt.date(2024, 1, 1), 3, None)


def test_up_matrices_by_region(spark):
    out_dir = scratch_path(spark, "t-up")
    lookup = fx.up_rs(spark, SF_SMALL)
    counts = demand_counts(prepare_visits(fx.visits(spark, SF_SMALL), lookup))
    paths = daily.render_up_by_region(counts, lookup, out_dir, "demand")
    assert "RS:SENSEESPECIFICAR_SE" in paths
    total = 0
    for region, path in paths.items():
        wide = spark.read.parquet(path)
        cols = [c for c in wide.columns if c.startswith("demanda__TOTAL_UP_")]
        total += wide.select(sum(F.col(f"`{c}`") for c in cols).alias("s")).agg(F.sum("s")).first()[0]
    visits = counts.where("scope = 'CAT' AND variable = 'TOTAL'").agg(F.sum("n")).first()[0]
    assert total == visits


def test_increments_with_state(spark):
    import datetime as dt

    store_path, state_path = scratch_path(spark, "t-inc-store"), scratch_path(spark, "t-inc-state")
    v, lk = fx.visits(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL)
    first = daily.run_demand_increment(v, lk, store_path, dt.date(1998, 12, 31), 30, state_path=state_path,
                                       run_at=dt.datetime(1999, 1, 1, 6))
    assert first.hwm_before is None and first.hwm_after < dt.date(1999, 1, 1)
    assert store.load_state(spark, state_path) == first.hwm_after
    second = daily.run_demand_increment(v, lk, store_path, dt.date(2001, 11, 5), 30, state_path=state_path)
    assert second.read_from == (first.hwm_after - dt.timedelta(days=29)).replace(day=1)
    full = demand_counts(prepare_visits(v, lk))
    stored = spark.read.parquet(store_path).drop("period")
    assert stored.exceptAll(full).count() == 0 and full.exceptAll(stored).count() == 0


def test_state_is_compared_with_the_store(spark):
    store_path, state_path = scratch_path(spark, "t-state-store"), scratch_path(spark, "t-state-file")
    v, lk = fx.visits(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL)
    first = daily.run_demand_increment(v, lk, store_path, dt.date(1996, 12, 31), 30, state_path=state_path)
    # A run that ended between writing and recording.
    daily.run_demand_increment(v, lk, store_path, dt.date(1997, 12, 31), 30)
    assert store.load_state(spark, state_path) == first.hwm_after
    info = daily.run_demand_increment(v, lk, store_path, dt.date(2001, 11, 5), 30, state_path=state_path)
    assert info.hwm_before > first.hwm_after and store.load_state(spark, state_path) == info.hwm_after
    # A store that lost days.
    with pytest.raises(daily.StateError, match="the store ends at None"):
        daily.run_demand_increment(v, lk, scratch_path(spark, "t-state-lost"), dt.date(2001, 11, 5), 30, state_path=state_path)


def test_diagnosis_increment_matches_full_count(spark):
    import datetime as dt

    from daymatrix.functions.icd import SELECTED_CODES
    from daymatrix.operators.diagnosis import diagnosis_counts, prepare_diagnoses

    path = scratch_path(spark, "t-dx-inc")
    dx, lk = fx.diagnoses(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL)
    daily.run_diagnosis_increment(dx, lk, path, dt.date(1998, 12, 31), 30)
    daily.run_diagnosis_increment(dx, lk, path, dt.date(2001, 11, 5), 30)
    full = diagnosis_counts(prepare_diagnoses(dx, lk), selected_codes=SELECTED_CODES)
    stored = spark.read.parquet(path).drop("period")
    assert stored.exceptAll(full).count() == 0 and full.exceptAll(stored).count() == 0


def test_empty_side_guard(spark):
    from daymatrix.operators.quality import both_present

    a = spark.createDataFrame([(1,)], "x INT")
    assert both_present(a, a) and not both_present(a, a.where("false"))


def test_historical_wide(spark):
    out_dir = scratch_path(spark, "t-hist-wide")
    d = daily.demand_final(spark, fx.visits(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL), out_dir)
    wide = spark.read.parquet(daily.historical_combined(spark, [d["demand_long"]], f"{out_dir}/h", wide=True))
    cat = spark.read.parquet(d["demand_cat"])
    assert "demanda__TOTAL_CAT" in wide.columns and wide.count() <= cat.count()
    assert wide.where(F.col("`demanda__TOTAL_CAT`").isNull()).count() == 0

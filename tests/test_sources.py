"""Readers, lookups and date parsing."""
import datetime as dt

from pyspark.sql import functions as F

from daymatrix.functions.clean import day_of
from daymatrix.functions.icd import SELECTED_CODES
from daymatrix.operators.diagnosis import diagnosis_counts, prepare_diagnoses
from daymatrix.operators.lookup import lookup_conflicts, unit_region_lookup
from daymatrix.operators.quality import unmatched_units_sample
from daymatrix.session import scratch_path
from daymatrix.sources import fixtures as fx
from daymatrix.sources import store
from daymatrix.sources.tables import read_lookup, read_selected_codes

from conftest import SF_SMALL


def test_selected_codes_csv_and_dataframe_path(spark):
    path = scratch_path(spark, "t-codes")
    rows = [(" a09 ",), ("A09",), ("b34",)] + [(c,) for c in SELECTED_CODES]
    spark.createDataFrame(rows, "ICD10_3 STRING").coalesce(1).write.option("header", True).csv(path)
    codes = read_selected_codes(spark, path)
    assert sorted(r.ICD10_3 for r in codes.collect()) == sorted(SELECTED_CODES)
    reduced = prepare_diagnoses(fx.diagnoses(spark, SF_SMALL), fx.up_rs(spark, SF_SMALL))
    a = diagnosis_counts(reduced, selected_codes=SELECTED_CODES)
    b = diagnosis_counts(reduced, selected_codes=codes)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lookup_csv_and_conflicts(spark):
    path = scratch_path(spark, "t-lookup")
    spark.createDataFrame([("12", "RS-A"), (" 12", "RS-B"), ("34", " RS-C ")], "codi_up STRING, RS STRING") \
        .coalesce(1).write.option("header", True).csv(path)
    lk = read_lookup(spark, path)
    norm = {r.UP: r.RS for r in unit_region_lookup(lk).collect()}
    assert norm == {"00012": "RS-A", "00034": "RS-C"}
    conflicts = lookup_conflicts(lk).collect()
    assert [(r.UP, list(r.regions)) for r in conflicts] == [("00012", ["RS-A", "RS-B"])]


def test_date_formats_in_order(spark):
    df = spark.createDataFrame([("2024-01-31",), ("31/01/2024",), ("01/31/2024",), ("nope",), (None,)],
                               "d STRING")
    out = [r.day for r in df.select(day_of(df, "d", ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("day")).collect()]
    assert out == [dt.date(2024, 1, 31), dt.date(2024, 1, 31), None, None, None]


def test_ignore_corrupt_files(spark):
    path = scratch_path(spark, "t-corrupt")
    store.append_batch(spark.createDataFrame([("a", 1)], "k STRING, n INT"), path)
    bad = f"{path}/batch_id=2"
    import os
    os.makedirs(bad.replace("file:", ""), exist_ok=True)
    with open(f"{bad}/part-bad.parquet".replace("file:", ""), "wb") as fh:
        fh.write(b"not parquet")
    assert store.read_staging(spark, path, ignore_corrupt=True).count() == 1


def test_unmatched_units_sample(spark):
    rows = fx.diagnoses(spark, SF_SMALL).select(F.lpad("up_c", 5, "0").alias("UP"))
    from daymatrix.operators.quality import unmatched_units

    full = sorted(r.UP for r in unmatched_units(rows, fx.up_rs(spark, SF_SMALL)).collect())
    sample = unmatched_units_sample(rows, fx.up_rs(spark, SF_SMALL), n=2).collect()
    assert full and [r.UP for r in sample] == full[:2]


def test_month_predicates():
    from daymatrix.sources.jdbc import month_predicates

    preds = month_predicates("DATA_VISITA", "1998-11-04", dt.date(1999, 1, 2), after="1998-06-30")
    assert preds == [
        "DATA_VISITA >= '1998-11-04' AND DATA_VISITA < '1998-12-01' AND DATA_VISITA > '1998-06-30'",
        "DATA_VISITA >= '1998-12-01' AND DATA_VISITA < '1999-01-01' AND DATA_VISITA > '1998-06-30'",
        "DATA_VISITA >= '1999-01-01' AND DATA_VISITA < '1999-01-03' AND DATA_VISITA > '1998-06-30'",
    ]


def test_lookup_lists_every_customer(spark):
    customers = spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert fx.up_rs(spark, SF_SMALL).count() == customers


def test_stored_bounds_come_from_the_footers(spark):
    from daymatrix.sources.scan import date_bounds, statistics_frame, stored_bounds

    def stored(name, rows, schema="day DATE, n INT"):
        path = scratch_path(spark, name)
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
        return path

    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), i) for i in range(30)] + [(None, 99)]
    path = stored("t-bounds", days)
    plan = statistics_frame(spark, path, "day")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(day), MAX(day), COUNT(*)]" in plan
    assert tuple(statistics_frame(spark, path, "day").first()) == (dt.date(2020, 1, 1), dt.date(2020, 1, 30), 31)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
    assert tuple(stored_bounds(spark, path, "day").first()) == (dt.date(2020, 1, 1), dt.date(2020, 1, 30))
    for lo, hi in ((None, None), ("2019-01-01", "2021-01-01"), ("2020-01-05", None), (None, "2020-01-20"), ("2022-01-01", None)):
        got = stored_bounds(spark, path, "day", lo and dt.date.fromisoformat(lo), hi and dt.date.fromisoformat(hi))
        assert got.collect() == date_bounds(spark.read.parquet(path), "day", lo, hi).collect()
    assert tuple(stored_bounds(spark, stored("t-bounds-null", [(None, 1), (None, 2)]), "day").first()) == (None, None)
    assert tuple(stored_bounds(spark, stored("t-bounds-none", []), "day").first()) == (None, None)
    times = stored("t-bounds-time", [(dt.datetime(2020, 1, 1, 5), 1)], "day TIMESTAMP_NTZ, n INT")
    assert tuple(stored_bounds(spark, times, "day").first()) == (dt.date(2020, 1, 1), dt.date(2020, 1, 1))

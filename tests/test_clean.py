"""Cleaning, padding, lookup and class rules on the FIXTURES 4.1 micro-fixture."""
import datetime as dt

from pyspark.sql import functions as F

from daymatrix.functions.clean import zfill
from daymatrix.operators.demand import demand_counts, prepare_visits

VIS_SCHEMA = ("id INT, DATA_VISITA TIMESTAMP, UP STRING, VISI_LLOC_VISITA STRING, "
              "VISI_SITUACIO_VISITA STRING, SERVEI_CODI STRING, TIPUS_CLASS STRING")


def _ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def visits(spark):
    rows = [
        (1, _ts("2024-01-01 08:30"), "12", "L1", "S1", "MF", "C9C"),
        (2, _ts("2024-01-01 17:00"), "12", "L1", None, "MF", " c9r "),
        (3, _ts("2024-01-02 00:00"), "00034", "L2", "S1", "INF", "9T"),
        (4, _ts("2024-01-02 10:00"), "99999", "L2", "", "INF", None),
        (5, _ts("2024-01-04 09:00"), "123456", None, "S2", "MF", "DALTRE"),
        (6, None, "12", "L1", "S1", "MF", "C9C"),
    ]
    return spark.createDataFrame(rows, VIS_SCHEMA)


def lookup(spark):
    return spark.createDataFrame([("12", "RS-A"), ("34", "SENSEESPECIFICAR_SE"), ("56", None)],
                                 "codi_up STRING, RS STRING")


def test_prepare_visits_matches_fixture(spark):
    out = prepare_visits(visits(spark), lookup(spark)).orderBy("day", "UP", "TIPUS_CLASS").collect()
    got = [(r.day.isoformat()[5:], r.UP, r.RS, r.VISI_SITUACIO_VISITA, r.VISI_LLOC_VISITA,
            r.TIPUS_CLASS, r.TIPUS_VISITA_AGRUPAT) for r in out]
    assert sorted(got) == sorted([
        ("01-01", "00012", "RS-A", "S1", "L1", "C9C", "PRESENCIAL"),
        ("01-01", "00012", "RS-A", "NA", "L1", "C9R", "PRESENCIAL"),
        ("01-02", "00034", "RS:SENSEESPECIFICAR_SE", "S1", "L2", "9T", "TELEFONICA"),
        ("01-02", "99999", "RS:SENSEESPECIFICAR_SE", "NA", "L2", "NA", "NA"),
        ("01-04", "123456", "RS:SENSEESPECIFICAR_SE", "S2", "NA", "DALTRE", "DOMICILIARIA"),
    ])


def test_zfill_like_python(spark):
    vals = ["12", "123456", "-12", "+7", "00034", "", "abc"]
    df = spark.createDataFrame([(v,) for v in vals], "s STRING")
    got = {r.s: r.p for r in df.select("s", zfill(F.col("s")).alias("p")).collect()}
    assert got == {v: v.zfill(5) for v in vals}


def test_missing_class_column_gives_na(spark):
    v = visits(spark).drop("TIPUS_CLASS")
    out = prepare_visits(v, lookup(spark)).select("TIPUS_CLASS", "TIPUS_VISITA_AGRUPAT").distinct().collect()
    assert [(r.TIPUS_CLASS, r.TIPUS_VISITA_AGRUPAT) for r in out] == [("NA", "NA")]


def test_duplicate_lookup_does_not_double(spark):
    lk = lookup(spark).unionByName(spark.createDataFrame([("12", "RS-B")], "codi_up STRING, RS STRING"))
    p = prepare_visits(visits(spark), lk)
    assert p.count() == 5
    assert {r.RS for r in p.where("UP = '00012'").collect()} == {"RS-A"}


def test_scope_totals_conserved(spark):
    long = demand_counts(prepare_visits(visits(spark), lookup(spark)))
    per = long.where("variable = 'TOTAL'").groupBy("day", "scope").agg(F.sum("n").alias("n"))
    rows = {(r.day.isoformat(), r.scope): r.n for r in per.collect()}
    for day in {d for d, _ in rows}:
        assert rows[(day, "CAT")] == rows[(day, "RS")] == rows[(day, "UP")]
    # every variable partitions the day's visits
    var = long.where("scope = 'CAT'").groupBy("day", "variable").agg(F.sum("n").alias("n")).collect()
    for r in var:
        assert r.n == rows[(r.day.isoformat(), "CAT")]

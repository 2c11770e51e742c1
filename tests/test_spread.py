"""Tasks of the unit counts hold a bounded number of rows, and parse plain codes directly."""
import random

from pyspark.sql import functions as F

from daymatrix import session
from daymatrix.functions.clean import pad_unit_code
from daymatrix.functions.icd import _code3_prefix, icd_code3_prefix
from daymatrix.operators.demand import demand_counts, prepare_visits
from daymatrix.operators.diagnosis import diagnosis_counts, grouped_long, prepare_diagnoses
from daymatrix.session import spread
from daymatrix.sources import fixtures as fx

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_follow_the_rows(spark):
    df = spark.range(10)
    for rows, n in ((0, 1), (5, 1), (60_000, 4), (800_000, 4), (900_000, 5), (50_000_000, 250)):
        assert spread(df, rows, ["id"]).rdd.getNumPartitions() == n
    assert spread(df, 1_000_000, ["id"], 6).rdd.getNumPartitions() == 30


def test_units_are_counted_after_one_shuffle_of_rows(spark, monkeypatch):
    """No shuffle, so no partial aggregate of an input split, of stacked rows or of
    raw codes by unit: one shuffle, of a number of its own, by day and unit."""
    monkeypatch.setattr(session, "LEAST_ROWS", 100)
    lookup = fx.up_rs(spark, SF_SMALL)
    reduced = prepare_diagnoses(fx.diagnoses(spark, SF_SMALL), lookup)
    visits = fx.visits(spark, SF_SMALL)
    for df, day in ((grouped_long(reduced, "ICD10_3", "UP"), "DATA_VISITA"), (diagnosis_counts(reduced, ("UP",)), "DATA_VISITA"),
                    (demand_counts(prepare_visits(visits, lookup), ("UP",)), "day")):
        shuffles = [x for x in _plan(df).splitlines() if "hashpartitioning(" in x and day in x]
        assert len(shuffles) == 1 and "REPARTITION_BY_NUM" in shuffles[0]


def test_plain_codes_parse_as_others(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("aZ09 .-+\t\n éß١") for _ in range(rng.randrange(7))) for _ in range(3000)]
    texts += ["a09.1", "A09", "12", "12\n", "\n12", "123456", "-12", "+7", "", " ", None, "ß09", "ı09x", "a١٢"]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert rows.where(~icd_code3_prefix("t").eqNullSafe(_code3_prefix("t"))).count() == 0
    got = rows.select("t", pad_unit_code("t").alias("u")).collect()
    assert [r.u for r in got] == [(t.strip().zfill(5) if t is not None and t.strip() else None) for t in (r.t for r in got)]
    assert rows.where(F.col("t").isNull()).select(pad_unit_code("t")).first()[0] is None

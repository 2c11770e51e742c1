"""Empty and degenerate inputs."""
import datetime as dt

from daymatrix.functions.names import with_feature
from daymatrix.operators.demand import demand_counts, prepare_visits
from daymatrix.operators.diagnosis import diagnosis_counts, prepare_diagnoses
from daymatrix.operators.join import join_daily
from daymatrix.operators.reshape import to_wide
from daymatrix.operators.timeseries import densify_long, densify_wide, fill_series

from test_clean import lookup, visits

DIAG = "data_visita TIMESTAMP, up_c STRING, problema_salut_c STRING"


def test_empty_visits(spark):
    counts = demand_counts(prepare_visits(visits(spark).where("false"), lookup(spark)))
    assert counts.count() == 0
    named = with_feature(counts).select("day", "feature", "n")
    wide = to_wide(named)
    assert wide.columns == ["timestamp"] and wide.count() == 0
    assert densify_wide(wide).count() == 0
    assert densify_long(named, ["feature"]).count() == 0
    assert fill_series(named, ["feature"], method="interpolate").count() == 0
    assert join_daily(named, named).count() == 0


def test_diagnoses_all_invalid(spark):
    rows = [(dt.datetime(2024, 1, 1), "1", "x?"), (dt.datetime(2024, 1, 1), None, "A09"),
            (None, "1", "A09"), (dt.datetime(2024, 1, 2), "1", None)]
    raw = spark.createDataFrame(rows, DIAG)
    red = prepare_diagnoses(raw, lookup(spark))
    assert red.count() == 0
    assert diagnosis_counts(red).count() == 0


def test_single_day_single_feature(spark):
    raw = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), "12", "A09.1")], DIAG)
    red = prepare_diagnoses(raw, lookup(spark))
    counts = diagnosis_counts(red, selected_codes=["A09"])
    got = sorted((r.scope, r.variable, r.value, r.n) for r in counts.collect())
    assert ("CAT", "ICD10_3", "A09", 1) in got and ("UP", "TOTAL", None, 1) in got
    assert len(got) == 3 * 4  # 3 scopes x (total, chapter, subchapter, code)


def test_feature_names_with_dots_spaces_backticks(spark):
    from daymatrix.operators.dedup import latest_wins
    from daymatrix.operators.reshape import prefix_columns, to_long
    from daymatrix.sources.store import narrow_types

    long = spark.createDataFrame([(dt.date(2024, 1, 1), "a.b", 1), (dt.date(2024, 1, 2), "c`d", 2),
                                  (dt.date(2024, 1, 2), "e f", 3)], "day DATE, feature STRING, n BIGINT")
    wide = to_wide(long)
    assert wide.columns == ["timestamp", "a.b", "c`d", "e f"]
    dense = densify_wide(wide, "timestamp", dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    assert dense.count() == 3
    assert to_long(wide).where("n > 0").count() == 3
    assert prefix_columns(wide, "P").columns == ["timestamp", "P_a.b", "P_c`d", "P_e f"]
    assert latest_wins(wide.withColumn("batch_id", wide["`a.b`"]), ["timestamp"]).count() == 2
    assert [t for _, t in narrow_types(wide).dtypes][1:] == ["tinyint"] * 3

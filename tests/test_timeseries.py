"""Densify and fills (FIXTURES 4.1 densify, 4.3 fills, 4.5 join)."""
import datetime as dt

from daymatrix.operators.join import join_daily, join_daily_long
from daymatrix.operators.timeseries import densify_long, densify_wide, fill_series

D = dt.date


def _series(spark, values):
    rows = [("f", D(2024, 1, i + 1), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "feature STRING, day DATE, n BIGINT")


def _vals(df):
    return [r.n for r in df.orderBy("day").collect()]


def test_fills(spark):
    s = _series(spark, [None, 1, None, None, 4, None])
    assert _vals(fill_series(s, ["feature"], method="ffill")) == [0, 1, 1, 1, 4, 4]
    assert _vals(fill_series(s, ["feature"], method="bfill")) == [1, 1, 4, 4, 4, 0]
    assert _vals(fill_series(s, ["feature"], method="interpolate")) == [0.0, 1.0, 2.0, 3.0, 4.0, 4.0]
    assert _vals(fill_series(s, ["feature"], method=None)) == [0, 1, 0, 0, 4, 0]


def test_fill_is_idempotent(spark):
    s = _series(spark, [None, 1, None, None, 4, None])
    once = fill_series(s, ["feature"], method="ffill")
    assert _vals(fill_series(once, ["feature"], method="ffill")) == _vals(once)


def test_densify_ranges(spark):
    sparse = spark.createDataFrame([("t", D(2024, 1, 1), 2), ("t", D(2024, 1, 2), 2), ("t", D(2024, 1, 4), 1)],
                                   "feature STRING, day DATE, n BIGINT")
    assert _vals(densify_long(sparse, ["feature"], start=D(2024, 1, 1), end=D(2024, 1, 5))) == [2, 2, 0, 1, 0]
    assert _vals(densify_long(sparse, ["feature"], start=D(2024, 1, 2), end=D(2024, 1, 3))) == [2, 0]
    assert densify_long(sparse.where("false"), ["feature"]).count() == 0
    wide = sparse.withColumnRenamed("day", "timestamp").drop("feature")
    dense = densify_wide(wide, "timestamp", D(2024, 1, 1), D(2024, 1, 5)).orderBy("timestamp").collect()
    assert [r.n for r in dense] == [2, 2, 0, 1, 0]


def test_densify_null_keys(spark):
    sparse = spark.createDataFrame([(None, D(2024, 1, 1), 2), (None, D(2024, 1, 3), 1)],
                                   "value STRING, day DATE, n BIGINT")
    assert _vals(densify_long(sparse, ["value"])) == [2, 0, 1]


def test_join_forward_fill(spark):
    dem = spark.createDataFrame([("x", D(2024, 1, 1), 1), ("x", D(2024, 1, 2), 2)], "feature STRING, day DATE, n BIGINT")
    dia = spark.createDataFrame([("y", D(2024, 1, 2), 10), ("y", D(2024, 1, 3), 20)], "feature STRING, day DATE, n BIGINT")
    out = join_daily(dem, dia, ("DEMAND", "DIAGNOSIS")).collect()
    assert [(r.timestamp.isoformat()[5:], r.DEMAND_x, r.DIAGNOSIS_y) for r in out] == [
        ("01-01", 1, 0), ("01-02", 2, 10), ("01-03", 2, 20)]


def test_join_empty_side(spark):
    dem = spark.createDataFrame([("x", D(2024, 1, 1), 1)], "feature STRING, day DATE, n BIGINT")
    assert join_daily_long(dem, dem.where("false")).count() == 0

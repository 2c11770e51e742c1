"""Small reshape / union / key helpers."""
from pyspark.sql import functions as F

from daymatrix.operators.dedup import data_id, union_batches
from daymatrix.operators.join import add_counts
from daymatrix.operators.reshape import align_union, prefix_columns


def test_align_union_fills_missing_columns(spark):
    a = spark.createDataFrame([("d1", 1)], "timestamp STRING, x BIGINT")
    b = spark.createDataFrame([("d2", 2)], "timestamp STRING, y BIGINT")
    rows = sorted(tuple(r) for r in align_union([a, b]).select("timestamp", "x", "y").collect())
    assert rows == [("d1", 1, 0), ("d2", 0, 2)]
    nulls = sorted(tuple(r) for r in union_batches([a, b]).select("timestamp", "x", "y").collect())
    assert nulls == [("d1", 1, None), ("d2", None, 2)]


def test_feature_outside_the_columns_fails(spark):
    import pytest

    from daymatrix.operators.reshape import to_wide

    long = spark.createDataFrame([("d1", "a", 1), ("d1", "b", 2)], "day STRING, feature STRING, n BIGINT")
    with pytest.raises(Exception, match="outside the given columns"):
        to_wide(long, features=["a"]).collect()
    assert [tuple(r) for r in to_wide(long, features=["a"], subset=True).collect()] == [("d1", 1)]


def test_add_counts_aligns_and_sums(spark):
    old = spark.createDataFrame([("d1", "f", 3), ("d2", "f", 1)], "day STRING, feature STRING, n BIGINT")
    new = spark.createDataFrame([("d2", "f", 4), ("d3", "g", 2)], "day STRING, feature STRING, n BIGINT")
    got = sorted(tuple(r) for r in add_counts(old, new, ["day", "feature"]).collect())
    assert got == [("d1", "f", 3), ("d2", "f", 5), ("d3", "g", 2)]


def test_data_id_and_prefix(spark):
    df = spark.createDataFrame([("2024-01-01", "A09", "00012", 1)], "ts STRING, code STRING, up STRING, n INT")
    assert df.select(data_id("ts", "code", "up").alias("id")).first().id == "2024-01-01|A09|00012"
    odd = spark.createDataFrame([("t", "X", None), ("t", None, "X"), ("t|X", "Y", "Z"), ("t", "X|Y", "Z")], "a STRING, b STRING, c STRING")
    assert odd.select(data_id("a", "b", "c")).distinct().count() == 4
    assert prefix_columns(df, "DIAG", keep=["ts"]).columns == ["ts", "DIAG_code", "DIAG_up", "DIAG_n"]

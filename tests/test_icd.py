"""ICD-10 parsing and first-match ranges (FIXTURES 4.2)."""
from pyspark.sql import functions as F

from daymatrix.functions.icd import (CHAPTER_RANGES, SUBCHAPTER_RANGES, icd_chapter, icd_code3_prefix,
                                     icd_code3_search, icd_normalize, icd_ordinal, icd_subchapter,
                                     range_map, ranges_frame)
from daymatrix.operators.diagnosis import prepare_diagnoses

CASES = [
    ("a09.1", "A091", "A09", "A09", "chapter_01", "SUBchapter_01_01"),
    (" e66 ", "E66", "E66", "E66", "chapter_05", "UNKNOWN"),
    ("K02", "K02", "K02", "K02", "UNKNOWN", "UNKNOWN"),
    ("I10", "I10", "I10", "I10", "chapter_09", "UNKNOWN"),
    ("I96", "I96", "I96", "I96", "chapter_10", "UNKNOWN"),
    ("D50", "D50", "D50", "D50", "chapter_03", "UNKNOWN"),
    ("u07.1", "U071", "U07", "U07", "chapter_22", "UNKNOWN"),
]
INVALID = [("ZU49", "U49"), ("1A2", None), ("AB1", None), ("Z", None), ("x?", None), ("", None), (None, None)]


def test_parse_and_classify(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "code STRING")
    code3 = icd_code3_prefix("code")
    out = df.select("code", icd_normalize("code").alias("norm"), code3.alias("p3"),
                    icd_code3_search("code").alias("s3"), icd_chapter(code3).alias("ch"),
                    icd_subchapter(code3).alias("sub")).collect()
    assert sorted(tuple(r) for r in out) == sorted(CASES)


def test_invalid_codes(spark):
    df = spark.createDataFrame([(c,) for c, _ in INVALID], "code STRING")
    out = {r.code: (r.norm, r.s3) for r in df.select("code", icd_normalize("code").alias("norm"),
                                                     icd_code3_search("code").alias("s3")).collect()}
    for code, search in INVALID:
        assert out[code] == (None, search)


def test_ordinals(spark):
    df = spark.createDataFrame([("A00",), ("I10",), ("Z99",)], "c STRING")
    assert [r.o for r in df.select(icd_ordinal("c").alias("o")).collect()] == [0, 810, 2599]


def test_range_map_equals_case(spark):
    codes = spark.range(2600).select(
        F.concat(F.expr("char(65 + cast(id / 100 as int))"), F.lpad((F.col("id") % 100).cast("string"), 2, "0"))
        .alias("code3"))
    for ranges, expr in [(CHAPTER_RANGES, icd_chapter), (SUBCHAPTER_RANGES, icd_subchapter)]:
        m = range_map(ranges_frame(spark, ranges))
        joined = codes.join(m, icd_ordinal("code3") == m["ordinal"], "left").select(
            "code3", F.coalesce("name", F.lit("UNKNOWN")).alias("a"), expr("code3").alias("b"))
        assert joined.where("a <> b").count() == 0
    unknown = codes.where(icd_chapter("code3") == "UNKNOWN").count()
    assert unknown == 126  # all K, D49, D90-D99, E91-E99, P97-P99, T99, V00, Y99


def test_dataframe_ranges_path_matches_list(spark):
    raw = spark.createDataFrame([("2024-01-01", "12", c[0]) for c in CASES],
                                "data_visita STRING, up_c STRING, problema_salut_c STRING")
    lk = spark.createDataFrame([("12", "RS-A")], "codi_up STRING, RS STRING")
    a = prepare_diagnoses(raw, lk).orderBy("ICD10_3").collect()
    b = prepare_diagnoses(raw, lk, chapter_ranges=ranges_frame(spark, CHAPTER_RANGES),
                          subchapter_ranges=ranges_frame(spark, SUBCHAPTER_RANGES)).orderBy("ICD10_3").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    assert {r.ICD10_3: r.ICD10_CHAPTER for r in a}["K02"] == "UNKNOWN"

"""Randomised checks of the Column rules. Inputs are built from an answer that
is known beforehand (a code, a label, a unit) plus noise that must not matter;
the rules are evaluated on Spark, one job per generated batch."""
from hypothesis import given, settings
from hypothesis import strategies as st

from daymatrix.functions.clean import clean_label, pad_unit_code, visit_class
from daymatrix.functions.icd import icd_chapter, icd_code3_prefix, icd_code3_search, icd_normalize

NOISE = st.text(alphabet=" .-+?_/\t", max_size=3)
BLANK = st.text(alphabet=" \t", max_size=3)

# Letters that lie in one chapter as a whole.
WHOLE_LETTERS = "FGJLMN"


@st.composite
def codes(draw):
    letter, digits = draw(st.sampled_from("ABCDEFGIJLMN")), draw(st.integers(0, 99))
    tail = draw(st.text(alphabet="0123456789XA", max_size=3))
    answer = f"{letter}{digits:02d}"
    shown = "".join(ch + draw(NOISE) for ch in answer + tail)
    return draw(NOISE) + (shown.lower() if draw(st.booleans()) else shown), answer, answer + tail


@settings(max_examples=15, deadline=None)
@given(st.lists(codes(), min_size=1, max_size=40))
def test_noise_does_not_change_a_code(spark, cases):
    df = spark.createDataFrame(cases, "shown STRING, code3 STRING, full STRING")
    rows = df.select("code3", "full", icd_normalize("shown").alias("norm"), icd_code3_prefix("shown").alias("prefix"),
                     icd_code3_search("shown").alias("found")).collect()
    for r in rows:
        assert (r.norm, r.prefix, r.found) == (r.full, r.code3, r.code3)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(WHOLE_LETTERS), st.integers(0, 99)), min_size=1, max_size=40))
def test_codes_of_one_letter_share_a_chapter(spark, cases):
    df = spark.createDataFrame([(f"{a}00", f"{a}{n:02d}") for a, n in cases], "first STRING, code STRING")
    for r in df.select(icd_chapter("first").alias("a"), icd_chapter("code").alias("b")).collect():
        assert r.a == r.b


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(BLANK, st.one_of(st.just(""), st.sampled_from(["7", "42", "00042", "123456", "c9r", "x y"])), BLANK),
                min_size=1, max_size=40))
def test_blanks_around_labels_and_units(spark, cases):
    known_pad = {"": None, "7": "00007", "42": "00042", "00042": "00042", "123456": "123456", "c9r": "00c9r", "x y": "00x y"}
    df = spark.createDataFrame([(a + core + b, core) for a, core, b in cases], "shown STRING, core STRING")
    rows = df.select("core", clean_label("shown").alias("label"), pad_unit_code("shown").alias("unit"), visit_class("shown").alias("cls")).collect()
    for r in rows:
        assert r.label == (r.core or "NA")
        assert r.unit == known_pad[r.core]
        assert r.cls == (r.core or "NA").upper()

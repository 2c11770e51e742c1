"""ICD-10 code parsing and range classification.

Codes are parsed with native string expressions. Chapter and subchapter are a
first-match lookup in an ordered range table. For a table given as a Python
list the lookup is one ``CASE`` expression (no join at all); for a table given
as a DataFrame the ranges are expanded into a code-ordinal map whose size is
bounded by the code space (26 x 100 = 2,600 ordinals), then broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymatrix.functions.clean import strip

UNKNOWN = "UNKNOWN"
CODE_SPACE = 26 * 100  # letters A-Z x two digits: every 3-character code

# ICD-10 chapter ranges, in priority order (first match wins;
# 03 and 04 repeat each other, 09 overlaps 10, and there is no range for K).
CHAPTER_RANGES: list[tuple[str, str, str]] = [
    ("chapter_01", "A00", "B99"),
    ("chapter_02", "C00", "D48"),
    ("chapter_03", "D50", "D89"),
    ("chapter_04", "D50", "D89"),
    ("chapter_05", "E00", "E90"),
    ("chapter_06", "F00", "F99"),
    ("chapter_07", "G00", "G99"),
    ("chapter_08", "H00", "H59"),
    ("chapter_09", "H60", "I95"),
    ("chapter_10", "I00", "I99"),
    ("chapter_11", "J00", "J99"),
    ("chapter_12", "L00", "L99"),
    ("chapter_13", "M00", "M99"),
    ("chapter_14", "N00", "N99"),
    ("chapter_15", "O00", "O99"),
    ("chapter_16", "P00", "P96"),
    ("chapter_17", "Q00", "Q99"),
    ("chapter_18", "R00", "R99"),
    ("chapter_19", "S00", "T98"),
    ("chapter_20", "V01", "Y98"),
    ("chapter_21", "Z00", "Z99"),
    ("chapter_22", "U00", "U99"),
]

# The live ICD-10 subchapter ranges, in priority order.
SUBCHAPTER_RANGES: list[tuple[str, str, str]] = [
    ("SUBchapter_01_01", "A00", "A09"),
    ("SUBchapter_01_02", "A15", "A19"),
    ("SUBchapter_01_03", "A20", "A28"),
    ("SUBchapter_01_04", "A30", "A49"),
    ("SUBchapter_01_05", "A50", "A64"),
    ("SUBchapter_01_06", "A65", "A69"),
    ("SUBchapter_01_07", "A70", "A74"),
    ("SUBchapter_01_08", "A75", "A79"),
    ("SUBchapter_01_09", "A80", "A89"),
    ("SUBchapter_01_10", "A92", "A99"),
]

# The selected 3-character codes (50).
SELECTED_CODES: list[str] = [
    "A09", "B34", "B35", "B37", "E66", "E78", "F41", "H10", "H60", "H61",
    "H65", "H66", "I10", "I16", "J00", "J02", "J03", "J11", "J20", "J22",
    "J30", "J40", "K02", "K04", "K08", "L30", "M25", "M54", "M77", "M79",
    "N30", "N39", "R05", "R07", "R10", "R11", "R42", "R50", "R51", "R53",
    "T14", "U07", "Z00", "Z01", "Z02", "Z11", "Z20", "Z30", "Z34", "Z71",
]


def _alnum_upper(c: Column | str) -> Column:
    """Upper case, only [A-Z0-9] kept. Stripping first is implied: white
    space is removed with every other non-alphanumeric character."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.upper(c.cast("string")), "[^A-Z0-9]", "")


def icd_normalize(c: Column | str) -> Column:
    """Upper, strip, keep [A-Z0-9]; must start with a letter and two digits,
    else null (P9)."""
    n = _alnum_upper(c)
    return F.when(n.rlike("^[A-Z][0-9]{2}"), n)


def icd_code3_prefix(c: Column | str) -> Column:
    """First three characters of the normalised code, null when it is not
    valid (P11); one extraction instead of test-then-cut. Text that begins with a
    letter and two digits needs no normalising for that."""
    raw = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(raw.rlike("^[A-Za-z][0-9]{2}"), F.upper(F.substring(raw, 1, 3))).otherwise(_code3_prefix(c))


def _code3_prefix(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_alnum_upper(c), "^[A-Z][0-9]{2}", 0), F.lit(""))


def icd_code3_search(c: Column | str) -> Column:
    """First letter+two-digit group anywhere in the cleaned code (P10)."""
    return F.nullif(F.regexp_extract(_alnum_upper(c), "[A-Z][0-9]{2}", 0), F.lit(""))


def icd_ordinal(code3: Column | str) -> Column:
    """(letter - 'A') * 100 + two digits (P12); null for null."""
    code3 = F.col(code3) if isinstance(code3, str) else code3
    return (F.ascii(F.substring(code3, 1, 1)) - 65) * 100 + F.substring(code3, 2, 2).cast("int")


def range_label(code3: Column | str, ranges: Sequence[tuple[str, str, str]]) -> Column:
    """First range (in list order) whose inclusive bounds hold the code, else
    UNKNOWN (J4). A letter and two digits sort as text in code order."""
    code3 = F.col(code3) if isinstance(code3, str) else code3
    named = [F.when(code3.between(lo, hi), F.lit(name)) for name, lo, hi in ranges]
    return F.coalesce(*named, F.lit(UNKNOWN))


def icd_chapter(code3: Column | str) -> Column:
    return range_label(code3, CHAPTER_RANGES)


def icd_subchapter(code3: Column | str) -> Column:
    return range_label(code3, SUBCHAPTER_RANGES)


def ranges_frame(spark: SparkSession, ranges: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A range list as a DataFrame ``(priority, name, lo, hi)``."""
    rows = [(i, name, lo, hi) for i, (name, lo, hi) in enumerate(ranges)]
    return spark.createDataFrame(rows, "priority INT, name STRING, lo STRING, hi STRING")


def range_map(ranges: DataFrame) -> DataFrame:
    """Expand a range table into ``(ordinal, name)``, first match by priority.

    Each range becomes the sequence of its ordinals (no theta join); the winner
    per ordinal is ``min_by(name, priority)``. The result has at most
    ``CODE_SPACE`` rows whatever the table size, so it is safe to broadcast.
    """
    lo = icd_ordinal(F.upper(strip("lo")))
    hi = icd_ordinal(F.upper(strip("hi")))
    return (
        ranges.where(lo.isNotNull() & hi.isNotNull() & (lo <= hi))
        .select("priority", "name", F.explode(F.sequence(lo, hi)).alias("ordinal"))
        .where(F.col("ordinal").between(0, CODE_SPACE - 1))
        .groupBy("ordinal")
        .agg(F.min_by("name", "priority").alias("name"))
    )


def classify_with_map(df: DataFrame, code3: str, ranges: DataFrame, out: str) -> DataFrame:
    """Attach ``out`` = first-match range name of ``code3`` using a range table
    held in a DataFrame; unmatched -> UNKNOWN."""
    m = range_map(ranges).withColumnRenamed("name", out)
    return (
        df.withColumn("__ordinal", icd_ordinal(code3))
        .join(F.broadcast(m), F.col("__ordinal") == m["ordinal"], "left")
        .drop("ordinal", "__ordinal")
        .withColumn(out, F.coalesce(F.col(out), F.lit(UNKNOWN)))
    )

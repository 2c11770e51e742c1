"""Readers for the source tables and the small reference lists.

Parquet scans are declared with ``spark.read``; the selects and filters that
callers add on top reach the scan as ``ReadSchema`` and ``PushedFilters``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymatrix.functions.clean import strip


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, e.g. ``read_table(spark, dir, "orders")``. Scans split
    by ``spark.sql.files.maxPartitionBytes`` and row groups, at any size and
    from any store alike."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_lookup(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Unit -> region lookup stored as CSV (header) or Parquet.

    The reference reads a workbook sheet; a workbook reader is not built, the
    sheet is exported as CSV or Parquet instead (see README).
    """
    if fmt == "csv":
        return spark.read.option("header", True).csv(path)
    return spark.read.format(fmt).load(path)


def read_selected_codes(spark: SparkSession, path: str) -> DataFrame:
    """Selected-code list: first column of a headed CSV, upper-cased, stripped,
    de-duplicated (S6)."""
    raw = spark.read.option("header", True).csv(path)
    first = raw.columns[0]
    return (
        raw.select(F.upper(strip(F.col(first))).alias("ICD10_3"))
        .where(F.col("ICD10_3").isNotNull() & (F.col("ICD10_3") != ""))
        .distinct()
    )

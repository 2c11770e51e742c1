"""Fixture views over the driver tables (FIXTURES.md section 3).

The driver ships TPC-H-like tables; these views give them the shape of the
health-care inputs: ``orders`` becomes visits, ``lineitem`` becomes coded
diagnoses and ``customer`` x ``nation`` becomes the unit -> region lookup.
Every view reads its whole source table, so its work grows with the data.
The same definitions, as SQL text, sit in ``daymatrix.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymatrix.sources.tables import read_table

# Fixed values of the fixture definition.
LOOKUP_SKIP_MODULUS = 17    # customers that the lookup lists without a region code
UNLISTED_MODULUS = 43       # orders whose rows name a unit that the lookup does not list
BARE_CODE_MODULUS = 7       # orders whose diagnoses carry a bare 3-character code
ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def _unit(order_key, column: str):
    code = F.col(column).cast("string")
    return F.when(order_key % UNLISTED_MODULUS == 0, F.concat(F.lit("U"), code)).otherwise(code)


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    situacio = (
        F.when(key % 31 == 0, F.lit(None).cast("string"))
        .when(key % 37 == 0, F.lit("  "))
        .otherwise(F.substring("o_orderpriority", 1, 1))
    )
    tipus_class = (
        F.when(key % 9 == 0, "C9C")
        .when(key % 9 == 1, " c9r ")
        .when(key % 9 == 2, "CALTRE")
        .when(key % 9 == 3, "D9D")
        .when(key % 9 == 4, "dALTRE")
        .when(key % 9 == 5, "9T")
        .when(key % 9 == 6, "")
        .when(key % 9 == 7, "ZZ")
    )
    return o.select(
        F.col("o_orderdate").alias("DATA_VISITA"),
        _unit(key, "o_custkey").alias("UP"),
        F.col("o_orderstatus").alias("VISI_LLOC_VISITA"),
        situacio.alias("VISI_SITUACIO_VISITA"),
        F.col("o_orderpriority").alias("SERVEI_CODI"),
        tipus_class.alias("TIPUS_CLASS"),
        F.col("o_orderstatus").alias("VISI_TIPUS_VISITA"),
    )


def up_rs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit -> region lookup (a dimension table: one row per listed unit)."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    rs = (
        F.when(key % LOOKUP_SKIP_MODULUS == 0, F.lit("  "))
        .when(key % 23 == 0, F.lit("SENSEESPECIFICAR_SE"))
        .when(key % 29 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("RS"), F.col("n_regionkey").cast("string")))
    )
    return (
        c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(key.cast("string").alias("codi_up"), rs.alias("RS"))
    )


def diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    okey = F.col("l_orderkey")
    letter = F.lit(ALPHABET).substr(
        (F.col("l_partkey") % 26).cast("int") + 1, F.lit(1)
    )
    code = F.concat(
        letter,
        F.lpad((okey % 100).cast("string"), 2, "0"),
        F.lit("."),
        F.col("l_linenumber").cast("string"),
    )
    problema = (
        F.when(okey % 59 == 0, F.lit(None).cast("string"))
        .when(okey % 53 == 0, F.lit("x?"))
        .when(okey % BARE_CODE_MODULUS == 0, F.upper(F.substring(code, 1, 3)))
        .otherwise(code)
    )
    return li.select(
        F.col("l_shipdate").alias("data_visita"),
        _unit(okey, "l_suppkey").alias("up_c"),
        problema.alias("problema_salut_c"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")

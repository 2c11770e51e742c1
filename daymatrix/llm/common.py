"""Helpers of the text operators: table access and written intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymatrix.session import scratch_path


#: Rows in an Arrow batch of whole texts. Rows are wide here (some hold a
#: hundred thousand characters), so Spark's 10,000 would be tens of MB a batch.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches between the JVM and Python for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: several
    readers share one computation, and a lost executor costs no more than a
    reread."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(docs: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``fn`` over the Arrow batches of ``docs``, which gives rows of the same
    columns. They travel by position, so that any name will do (Spark reads
    dots in the names that ``mapInArrow`` passes on)."""
    names = docs.columns
    numbered = [f"c{i}" for i in range(len(names))]
    plain = docs.toDF(*numbered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(b.rename_columns(names) for b in batches):
            yield out.rename_columns(numbered)

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column of ``taken`` has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


#: Rows of a key list that may be broadcast.
BROADCAST_KEYS = 100_000


def without(docs: DataFrame, keys: DataFrame, on) -> DataFrame:
    """The rows of ``docs`` that match none of ``keys`` (one key column). The
    keys are written and counted first: a short list is broadcast, so that the
    texts stay where they are; a longer one is joined by a shuffle."""
    keys = written(keys, "keys")
    return docs.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, on, "left_anti")


def one_row_an_id(docs: DataFrame) -> DataFrame:
    """Of the rows with one ``doc_id`` the one whose text has the smallest hash;
    of equal texts one. Ids that stand once are only counted."""
    again = written(docs.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    few = again.count()
    if not few:
        return docs
    columns = [F.col(f"`{c}`") for c in docs.columns]
    repeated = docs.join(F.broadcast(again) if few <= BROADCAST_KEYS else again, "doc_id", "left_semi").select(*columns)
    first = repeated.groupBy("doc_id").agg(F.min_by(F.struct(*columns), F.xxhash64("text")).alias("first"))
    kept = first.select(*(F.col("first").getField(c).alias(c) for c in docs.columns))
    return without(docs, again, "doc_id").select(*columns).unionByName(kept)

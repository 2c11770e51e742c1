"""Structured Streaming form of the daily count.

``readStream`` over a Parquet folder and ``foreachBatch``: each micro-batch is
counted per day and key in one aggregation and stored as its own partition,
named by the batch id. The result is the sum over the batches, so a row counts
however late it arrives; no state is kept and no watermark drops it. A batch
that is replayed after a failure replaces its own partition, which makes the
sink exactly-once. The checkpoint lives in the shared folder, so a restarted
query resumes from its offsets.

Compaction sums the batches up to the last but one into a generation, a
partition with a negative number, and commits "this generation, and the batches
after that one" as one record (``sources.commits``). A reader goes by the record it
read first, so it counts every batch once whenever it looks; the newest batch, the
only one that can be replayed, is never part of a generation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymatrix.sources import commits
from daymatrix.sources.store import drop_partitions, partition_values, path_exists

EPOCH_COL = "epoch"


def daily_key_counts(rows: DataFrame, ts_col: str = "ts", key_col: str = "event_type") -> DataFrame:
    """``(day, key, n)`` of some rows."""
    return (rows.groupBy(F.to_date(F.col(ts_col).cast("timestamp")).alias("day"), F.col(key_col))
            .agg(F.count(F.lit(1)).alias("n")))


def _live(spark: SparkSession, sink_path: str, state: dict) -> DataFrame:
    rows = spark.read.parquet(sink_path)
    if not state:
        return rows.where(F.col(EPOCH_COL) >= 0)
    return rows.where((F.col(EPOCH_COL) == state["base"]) | (F.col(EPOCH_COL) > state["through"]))


def _totals(rows: DataFrame, key_col: str) -> DataFrame:
    return rows.groupBy("day", key_col).agg(F.sum("n").cast("long").alias("n"))


def read_daily_counts(spark: SparkSession, sink_path: str, key_col: str = "event_type") -> DataFrame:
    """Counts per day and key over all stored batches."""
    return _totals(_live(spark, sink_path, commits.snapshot(spark, sink_path).extra), key_col)


def compact_daily_counts(spark: SparkSession, sink_path: str, key_col: str = "event_type") -> int | None:
    """Sum all batches but the newest into one generation of the sink and switch
    readers to it; returns the last batch that it holds (``None``: nothing to
    do). May run while the stream does. What an earlier compaction replaced is
    deleted first. Of two compactions at once the later one raises."""
    seen = commits.snapshot(spark, sink_path)
    state = seen.extra
    stored = [int(v) for v in partition_values(spark, sink_path, EPOCH_COL)]
    if state:
        old = [e for e in stored if 0 <= e <= state["through"] or state["base"] < e < 0]
        drop_partitions(spark, sink_path, EPOCH_COL, [str(e) for e in old])
    through = max((e for e in stored if e >= 0), default=0) - 1
    if through <= state.get("through", -1):
        return None
    base = -commits.claim(spark, sink_path)
    rows = _live(spark, sink_path, state).where(F.col(EPOCH_COL) <= through)
    (_totals(rows, key_col).withColumn(EPOCH_COL, F.lit(base).cast("long"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(EPOCH_COL).parquet(sink_path))

    def change(latest: commits.Snapshot):
        if latest.version != seen.version:
            raise commits.CommitConflict("another compaction came first")
        return [], {"base": base, "through": through}

    commits.commit(spark, sink_path, change)
    return through


def _store(sink_path: str, ts_col: str, key_col: str, compact_every: int | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        (daily_key_counts(batch, ts_col, key_col)
            .withColumn(EPOCH_COL, F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(EPOCH_COL).parquet(sink_path))
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_daily_counts(batch.sparkSession, sink_path, key_col)
    return write


def run_daily_counts(spark: SparkSession, source: str, schema, sink_path: str, checkpoint_path: str,
                     ts_col: str = "ts", key_col: str = "event_type",
                     max_files_per_trigger: int | None = None, compact_every: int | None = None) -> DataFrame:
    """Run the stream to the end of the available input (``availableNow``),
    however long that takes, and return the counts as a batch DataFrame. The
    sink is compacted after every ``compact_every`` batches, if that is given.
    ``source`` is a folder of Parquet files or a glob over the table's files."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (reader.parquet(source).writeStream
             .option("checkpointLocation", checkpoint_path)
             .foreachBatch(_store(sink_path, ts_col, key_col, compact_every))
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if not path_exists(spark, sink_path):  # no input at all
        empty = spark.createDataFrame([], schema)
        daily_key_counts(empty, ts_col, key_col).withColumn(EPOCH_COL, F.lit(0).cast("long")).write.parquet(sink_path)
    return read_daily_counts(spark, sink_path, key_col)

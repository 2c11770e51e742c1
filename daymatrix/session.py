"""Session construction and the shared working folder.

Everything that must outlive a task (written tables, checkpoints, streaming
state) goes under ``spark.checkpoint.dir``, which on a cluster names a shared
file system. We only pick a folder of our own when the session has none, as
in local tests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Delete checkpoint files once their DataFrame is garbage collected, so
    # the shared folder does not grow run after run.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "daymatrix",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    # The time zone also applies when getOrCreate returned an existing session:
    # event-time windows and TIMESTAMP_NTZ -> TIMESTAMP casts depend on it.
    spark.conf.set("spark.sql.session.timeZone", settings["spark.sql.session.timeZone"])
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only in local mode, when
    it is unset (local runs, tests), a fresh local folder is created and
    registered; on a cluster an unset setting is an error.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder is not shared by the executors.
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or S3)"
            )
        configured = tempfile.mkdtemp(prefix="daymatrix-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one written table."""
    root = checkpoint_root(spark)
    return f"{root}/daymatrix/{name}-{uuid.uuid4().hex[:12]}"


#: Rows that one task aggregates at the finest level, and the fewest worth a task.
TASK_ROWS, LEAST_ROWS = 200_000, 10_000


def spread(df: DataFrame, rows: int, keys: Sequence[str], stacked: int = 1) -> DataFrame:
    """``df`` of about ``rows`` rows, dealt by ``keys`` to as many tasks as hold
    ``TASK_ROWS`` each, however many there are. For aggregations with about as many
    groups as rows: a partial aggregate before the shuffle would hold a whole input
    split in memory for nothing, and adaptive merging goes by compressed bytes, so
    that the groups of one task would grow with the input. ``stacked`` is the number
    of rows that each row becomes afterwards."""
    idle = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // LEAST_ROWS))
    return df.repartition(max(1, idle, -(-rows * stacked // TASK_ROWS)), *keys)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back, for frames
    that several jobs scan: compressed, and read by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in
    the shared folder.

    Used for small aggregated frames that feed several jobs (bounds, pivot
    lists, the final plan): the expensive scan and aggregation then run
    once, and a lost executor does not send the job back to the source.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_all(*dfs: DataFrame) -> list[DataFrame]:
    """:func:`materialize` several independent frames, their jobs submitted
    from separate driver threads so they run side by side."""
    if len(dfs) < 2:
        return [materialize(d) for d in dfs]
    with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
        return list(pool.map(materialize, dfs))

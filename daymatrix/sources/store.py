"""Staging and final stores on Parquet.

A staging store holds one folder per batch, ``batch_id=<id>``, and a commit record
(``sources.commits``) of the live ones. An append claims an id, writes its folder
and commits it with what was observed while writing: rows, first and last
timestamp, schema. So a reader sees whole batches only, the manifest (X11) and the
union schema (U1) are read from the record and not from the data, and compaction
and retention change the set of batches at once. Final stores are overwritten
atomically per write, or per day partition with dynamic partition overwrite.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymatrix.functions.clean import to_count
from daymatrix.functions.names import qcol
from daymatrix.operators.dedup import latest_wins
from daymatrix.operators.reshape import bounded_values, to_wide
from daymatrix.operators.timeseries import bounds, densify_wide
from daymatrix.session import scratch_path
from daymatrix.sources import commits
from daymatrix.sources.commits import file_system

BATCH_COL = "batch_id"
SEQ_COL = "row_seq"   # order of the rows within a batch, fixed at append
SOURCE_COL = "source_batch"   # the batch that a row first came with; kept by compaction
LOADED_COL = "loaded_at"   # when a batch was appended, by the caller's clock
# Rows per staging file. Small chunks only bound a single process's memory;
# on a cluster they would make many small files, so the default keeps files
# in the order of 100 MB for count rows. It stays a parameter.
DEFAULT_RECORDS_PER_FILE = 2_000_000


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at ``path`` (file-system check: probing by
    reading would log a stack trace for every absent store)."""
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a dataset's first partition column, from its folders."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable[str]) -> list[str]:
    """Delete whole partitions by value; returns those that were there."""
    fs, _ = file_system(spark, path)
    jvm = spark.sparkContext._jvm
    dropped = []
    for value in values:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={value}")
        if fs.exists(p):
            fs.delete(p, True)
            dropped.append(value)
    return dropped


def _folder(batch_id: int) -> str:
    return f"{BATCH_COL}={batch_id}"


def _write_batch(df: DataFrame, path: str, bid: int, max_records_per_file: int, ts_col: str | None) -> dict | None:
    """Write one batch folder; returns its entry for the record, with what was
    observed while writing, or ``None`` if there are no rows."""
    spark = df.sparkSession
    seen = Observation()
    stats = [F.count(F.lit(1)).alias("n"), F.max(LOADED_COL).cast("string").alias("updated")]
    if ts_col is not None:
        stats += [F.min(qcol(ts_col)).cast("string").alias("lo"), F.max(qcol(ts_col)).cast("string").alias("hi")]
    (df.observe(seen, *stats).write.mode("errorifexists")
       .option("maxRecordsPerFile", max_records_per_file)
       .option("compression", "snappy")
       .parquet(f"{path}/{_folder(bid)}"))
    got = seen.get
    if not got["n"]:
        fs, p = file_system(spark, f"{path}/{_folder(bid)}")
        fs.delete(p, True)
        return None
    return {"id": bid, "num_rows": got["n"], "last_update": got["updated"], "ts_col": ts_col,
            "ts_type": df.schema[ts_col].dataType.simpleString() if ts_col else None,
            "min_timestamp": got.get("lo"), "max_timestamp": got.get("hi")}


def _with_columns(known: str | None, schema: T.StructType) -> str:
    """The registered schema with the columns that are new in ``schema``."""
    fields = {f.name: f for f in T.StructType.fromJson(json.loads(known)).fields} if known else {}
    for f in schema.fields:
        if f.name in fields and fields[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {fields[f.name].dataType.simpleString()} in the store, {f.dataType.simpleString()} in the batch")
        fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return T.StructType(list(fields.values())).json()


def append_batch(df: DataFrame, path: str, batch_id: int | None = None, max_records_per_file: int = DEFAULT_RECORDS_PER_FILE,
                 loaded_at: dt.datetime | None = None, ts_col: str | None = None,
                 check: Callable[[DataFrame], None] | None = None) -> int:
    """Append ``df`` as one batch (S10, S11); returns its ``batch_id``.

    Files hold at most ``max_records_per_file`` rows (X26). ``ts_col`` names the
    column whose first and last value the manifest records. An empty input
    commits nothing, so it has no manifest row either; it is not probed
    beforehand, which would compute the input twice. ``check`` is given the batch
    as written, before it is committed; if it raises, the folder goes and nothing
    is appended. Writers may run side by side: ids are claimed, and each batch is
    seen once it is committed.
    """
    spark = df.sparkSession
    bid = commits.claim(spark, path, batch_id)
    rows = (df.drop(BATCH_COL).withColumn(SEQ_COL, F.monotonically_increasing_id())
            .withColumn(SOURCE_COL, F.lit(bid))
            .withColumn(LOADED_COL, F.lit(loaded_at).cast("timestamp_ntz")))
    _with_columns(commits.snapshot(spark, path).extra.get("schema"), rows.schema)  # refuse before writing
    entry = _write_batch(rows, path, bid, max_records_per_file, ts_col)
    if entry and check is not None:
        try:
            check(spark.read.schema(rows.schema).parquet(f"{path}/{_folder(bid)}"))
        except Exception:
            fs, p = file_system(spark, f"{path}/{_folder(bid)}")
            fs.delete(p, True)
            raise
    if entry:
        commits.commit(spark, path, lambda seen: (
            seen.live + [entry], {**seen.extra, "schema": _with_columns(seen.extra.get("schema"), rows.schema)}))
    return bid


def adopt_batches(spark: SparkSession, path: str) -> list[int]:
    """Commit the ``batch_id=`` folders of a store that has no record yet (one
    written by another tool), their schemas merged from the files."""
    if commits.snapshot(spark, path).version:
        raise commits.CommitConflict("the store has a record already")
    ids = [int(v) for v in partition_values(spark, path, BATCH_COL)]
    found = spark.read.option("mergeSchema", True).parquet(path).drop(BATCH_COL)
    for c, kind in ((SEQ_COL, "long"), (SOURCE_COL, "int"), (LOADED_COL, "timestamp_ntz")):
        if c not in found.columns:
            found = found.withColumn(c, F.lit(None).cast(kind))
    for bid in ids:
        commits.claim(spark, path, bid)
    commits.commit(spark, path, lambda seen: (
        [{"id": i, "ts_col": None} for i in ids], {**seen.extra, "schema": _with_columns(None, found.schema)}))
    return ids


def _read_batches(spark: SparkSession, path: str, seen: commits.Snapshot, ignore_corrupt: bool = False) -> DataFrame:
    if not seen.version:
        raise FileNotFoundError(f"no committed batch at {path}; see adopt_batches")
    schema = T.StructType.fromJson(json.loads(seen.extra["schema"])).add(BATCH_COL, T.IntegerType())
    if not seen.live:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    if ignore_corrupt:
        reader = reader.option("ignoreCorruptFiles", True)
    rows = reader.parquet(*[f"{path}/{_folder(i)}" for i in seen.ids])
    return rows.withColumn(SOURCE_COL, F.coalesce(SOURCE_COL, BATCH_COL))


def read_staging(spark: SparkSession, path: str, ignore_corrupt: bool = False, keep_meta: bool = False) -> DataFrame:
    """All live batches, columns unioned across batches by the recorded schema
    (U1, S13; no file footer is read for it); ``keep_meta`` keeps each row's
    first batch, its place in that and the time of the append."""
    staged = _read_batches(spark, path, commits.snapshot(spark, path), ignore_corrupt)
    return staged if keep_meta else staged.drop(SEQ_COL, SOURCE_COL, LOADED_COL)


def _latest(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    return latest_wins(staged, keys, [SOURCE_COL, SEQ_COL])


def load_staging(spark: SparkSession, path: str, keys: Sequence[str], ignore_corrupt: bool = False) -> DataFrame:
    """Staging rows, the last row per key wins: latest batch, and within it the
    row that was appended last (S12, D1)."""
    staged = read_staging(spark, path, ignore_corrupt, keep_meta=True)
    return _latest(staged, keys).drop(SEQ_COL, SOURCE_COL, LOADED_COL)


MANIFEST = ["min_timestamp", "max_timestamp", "num_rows", "last_update"]


def stored_manifest(spark: SparkSession, path: str, ts_col: str) -> DataFrame:
    """The manifest (A13) as recorded at the appends: ``batch_id,
    min_timestamp, max_timestamp, num_rows, last_update``. Only batches that
    were appended without ``ts_col`` are read."""
    seen = commits.snapshot(spark, path)
    known = [e for e in seen.live if e["ts_col"] == ts_col]
    kind = T.StructType.fromJson(json.loads(seen.extra["schema"]))[ts_col].dataType.simpleString() if seen.version else "timestamp"
    rows = [(e["id"], *(e[c] for c in MANIFEST)) for e in known]
    recorded = spark.createDataFrame(rows, f"{BATCH_COL} INT, min_timestamp STRING, max_timestamp STRING, num_rows BIGINT, last_update STRING")
    recorded = recorded.select(BATCH_COL, *(F.col(c).cast(kind).alias(c) for c in MANIFEST[:2]), "num_rows", F.col("last_update").cast("timestamp_ntz").alias("last_update"))
    others = [e for e in seen.live if e["ts_col"] != ts_col]
    if not others:
        return recorded
    scanned = _read_batches(spark, path, commits.Snapshot(seen.version, others, [], seen.extra))
    return recorded.unionByName(manifest(scanned, ts_col))


def manifest(staged: DataFrame, ts_col: str) -> DataFrame:
    """Per batch: ``batch_id, min_timestamp, max_timestamp, num_rows`` and, if
    the rows carry it, ``last_update`` (A13)."""
    updated = [F.max(LOADED_COL).alias("last_update")] if LOADED_COL in staged.columns else []
    return staged.groupBy(BATCH_COL).agg(
        F.min(ts_col).alias("min_timestamp"),
        F.max(ts_col).alias("max_timestamp"),
        F.count(F.lit(1)).alias("num_rows"),
        *updated,
    )


def retention_flags(man: DataFrame, as_of, retention_days: int = 90) -> DataFrame:
    """``keep`` = newest timestamp not strictly older than ``as_of - days``.

    The clock is an argument, never the wall clock, so reruns are repeatable.
    """
    cutoff = F.date_sub(F.lit(_as_date(as_of)), retention_days)
    return man.withColumn("keep", F.to_date("max_timestamp") >= cutoff)


def drop_batches(spark: SparkSession, path: str, batch_ids: Iterable[int]) -> list[int]:
    """Take batches out of the store (I6, I7) at once; returns those that were
    live. Their folders go with a later :func:`vacuum`."""
    gone: list[int] = []
    wanted = {int(b) for b in batch_ids}

    def change(seen: commits.Snapshot):
        gone[:] = [i for i in seen.ids if i in wanted]
        return [e for e in seen.live if e["id"] not in wanted], seen.extra

    if wanted:
        commits.commit(spark, path, change)
    return gone


def vacuum(spark: SparkSession, path: str) -> list[int]:
    """Delete the folders of batches that went out before the last commit."""
    return commits.vacuum(spark, path, _folder)


def apply_retention(spark: SparkSession, path: str, ts_col: str, as_of, retention_days: int = 90) -> list[int]:
    """Drop staging batches older than the retention window, by the recorded
    manifest; returns the ids. Folders that earlier runs took out are deleted."""
    vacuum(spark, path)
    flags = retention_flags(stored_manifest(spark, path, ts_col), as_of, retention_days)
    old = [r[BATCH_COL] for r in flags.where(~F.col("keep")).select(BATCH_COL).collect()]
    return drop_batches(spark, path, old)


def save_final(df: DataFrame, path: str, compression: str = "snappy",
               partition_by: Sequence[str] | None = None, mode: str = "overwrite",
               replace_partitions_only: bool = False, row_group_bytes: int | None = None) -> None:
    """Final store write (S14, S15). An overwrite replaces the whole dataset
    (static mode, whatever the session default), so partitions absent from
    ``df`` do not survive from an earlier run; ``replace_partitions_only``
    switches to dynamic mode, replacing just the partitions present in ``df``.
    ``row_group_bytes`` bounds the row groups."""
    w = (df.write.mode(mode).option("compression", compression)
         .option("partitionOverwriteMode", "dynamic" if replace_partitions_only else "static"))
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def staging_to_final(spark: SparkSession, staging_path: str, final_path: str, keys: Sequence[str], ts_col: str,
                     lo=None, hi=None, as_of=None, retention_days: int = 90) -> list[int]:
    """One run from staging to final (I5): the last row per key of the days
    ``[lo, hi]`` replaces the final store; then, if ``as_of`` is given, batches
    past the retention are dropped. Returns their ids."""
    latest = load_staging(spark, staging_path, keys)
    if lo is not None and hi is not None:
        latest = latest.where(F.col(ts_col).between(F.lit(_as_date(lo)), F.lit(_as_date(hi))))
    save_final(latest, final_path)
    return apply_retention(spark, staging_path, ts_col, as_of, retention_days) if as_of is not None else []


def write_wide_blocks(long: DataFrame, path: str, block_columns: int = 250, key: str = "day", feature: str = "feature",
                      value: str = "n", start=None, end=None) -> list[str]:
    """A zero-filled dense matrix of any number of columns (R6, J6), as several
    Parquet outputs ``<path>/block=<i>`` of about ``block_columns`` columns each
    and the same days. Features are dealt to blocks by hash; the driver knows
    the names of one block at a time. Returns the blocks' paths."""
    spark = long.sparkSession
    n = long.select(feature).where(F.col(feature).isNotNull()).distinct().count()
    blocks = max(1, -(-n // block_columns))
    staged = scratch_path(spark, "wide-blocks")
    block = F.pmod(F.xxhash64(feature), F.lit(blocks)).cast("int").alias("block")
    long.select(block, key, feature, value).hint("rebalance", "block").write.partitionBy("block").parquet(staged)
    stored = spark.read.parquet(staged)
    lo, hi = bounds(stored, key)
    lo, hi = (start or lo), (end or hi)
    out = []
    for b in range(blocks):
        part = stored.where(F.col("block") == b).drop("block")
        wide = to_wide(part, key, feature, value, features=bounded_values(part, feature, 100 * block_columns), cap=100 * block_columns)
        if lo is not None and hi is not None:
            wide = densify_wide(wide, "timestamp", lo, hi)
        out.append(f"{path}/block={b}")
        save_final(wide, out[-1])
    return out


def load_final(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Final store, or an empty frame of ``schema`` when nothing is stored yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def save_matrix(wide: DataFrame, path: str, key: str = "timestamp", compression: str = "snappy") -> None:
    """Dual write of a wide matrix, Parquet at ``<path>.parquet`` and headed
    CSV at ``<path>.csv`` (S8); the CSV is written from the Parquet output, so
    the frame is computed once."""
    save_final(wide, f"{path}.parquet", compression)
    save_matrix_csv(wide.sparkSession.read.parquet(f"{path}.parquet"), f"{path}.csv", key)


def compact_staging(spark: SparkSession, path: str, keys: Sequence[str], ts_col: str | None = None) -> int:
    """Rewrite the latest row per key as one new batch that takes the place of
    the batches read, in one commit (I7). Returns the new batch id.

    Batches appended meanwhile stay, and win or lose by their own ids as before:
    every row keeps the batch it first came with and its place in that. If one of
    the batches read has gone meanwhile, nothing changes and the commit raises.
    Folders that earlier compactions replaced are deleted."""
    vacuum(spark, path)
    seen = commits.snapshot(spark, path)
    latest = _latest(_read_batches(spark, path, seen), keys).drop(BATCH_COL)
    if ts_col is None:
        named = {e["ts_col"] for e in seen.live}
        ts_col = named.pop() if len(named) == 1 else None
    bid = commits.claim(spark, path)
    entry = _write_batch(latest, path, bid, DEFAULT_RECORDS_PER_FILE, ts_col)
    commits.replace(spark, path, seen.ids, [entry] if entry else [])
    return bid


STATE_SCHEMA = T.StructType([
    T.StructField("last_loaded_date", T.DateType()),
    T.StructField("updated_at", T.TimestampType()),
])


def save_state(spark: SparkSession, path: str, last_loaded_date, updated_at) -> None:
    """One-row watermark state ``(last_loaded_date, updated_at)`` (I3). The
    clock is an argument."""
    spark.createDataFrame([(_as_date(last_loaded_date), updated_at)], STATE_SCHEMA) \
        .coalesce(1).write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> dt.date | None:
    """The stored watermark, or ``None`` when no state was written."""
    row = load_final(spark, path, STATE_SCHEMA).agg(F.max("last_loaded_date").alias("d")).collect()[0]
    return None if row is None else row["d"]


def save_matrix_csv(wide: DataFrame, path: str, key: str = "timestamp", label: str = "Timestamp") -> None:
    """Wide matrix as headed CSV with the ``Timestamp`` label."""
    wide.withColumnRenamed(key, label).orderBy(label).write.mode("overwrite").option("header", True).csv(path)


def load_matrix_csv(spark: SparkSession, path: str, key: str = "timestamp", label: str = "Timestamp") -> DataFrame:
    """Read a wide CSV matrix back; cells are coerced to BIGINT (bad -> null, P19)."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(
        F.to_date(F.col(label)).alias(key),
        *[to_count(qcol(c)).alias(c) for c in raw.columns if c != label],
    ).orderBy(key)


# --- type narrowing (P20) -------------------------------------------------

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)
FLOAT32_MAX = 3.4028234663852886e38


def numeric_ranges(df: DataFrame) -> DataFrame:
    """One aggregation pass: ``(column_name, min_value, max_value, kind)`` for
    every numeric column, as rows (no driver collect)."""
    numeric = [f for f in df.schema.fields if isinstance(f.dataType, _INTEGRAL + _FRACTIONAL)]
    if not numeric:
        return df.sparkSession.createDataFrame(
            [], "column_name STRING, min_value DOUBLE, max_value DOUBLE, kind STRING")
    aggs = []
    for f in numeric:
        aggs += [F.min(qcol(f.name)).cast("double").alias(f"min__{f.name}"),
                 F.max(qcol(f.name)).cast("double").alias(f"max__{f.name}")]
    one = df.agg(*aggs)
    stacked = F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"),
                 qcol(f"min__{f.name}").alias("min_value"),
                 qcol(f"max__{f.name}").alias("max_value"),
                 F.lit("integral" if isinstance(f.dataType, _INTEGRAL) else "fractional").alias("kind"))
        for f in numeric
    ]))
    return one.select(stacked)


def narrow_type_expr(min_value: Column, max_value: Column, kind: Column) -> Column:
    """Narrowest Spark type holding ``[min, max]`` (Spark has no unsigned types)."""
    def within(lo, hi):
        return (min_value >= lo) & (max_value <= hi)
    integral = (
        F.when(min_value.isNull(), F.lit("tinyint"))
        .when(within(-128, 127), F.lit("tinyint"))
        .when(within(-32768, 32767), F.lit("smallint"))
        .when(within(-2147483648, 2147483647), F.lit("int"))
        .otherwise(F.lit("bigint"))
    )
    fractional = F.when(
        min_value.isNull() | ((min_value > -FLOAT32_MAX) & (max_value < FLOAT32_MAX)), F.lit("float")
    ).otherwise(F.lit("double"))
    return F.when(kind == "integral", integral).otherwise(fractional)


def narrow_report(df: DataFrame) -> DataFrame:
    r = numeric_ranges(df)
    return r.select("column_name", "min_value", "max_value",
                    narrow_type_expr(F.col("min_value"), F.col("max_value"), F.col("kind")).alias("narrow_type"))


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast every numeric column to its narrowest type (one pass; the
    per-column bounds are a single row of scalars)."""
    plan = {r["column_name"]: r["narrow_type"] for r in narrow_report(df).collect()}
    return df.select(*[qcol(c).cast(plan[c]).alias(c) if c in plan else qcol(c) for c in df.columns])


def _as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d)[:10])

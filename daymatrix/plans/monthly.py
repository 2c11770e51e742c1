"""Forward-filled daily series kept by month, redone only where counts changed.

The full build puts every feature on every day and fills forward from the first
day on, so a new day would redo all years. Here the filled cells are stored by
month, and with each month the state at its end: each feature's last value. A run
seeds the months from the first changed one on with the state before it. Where
the state at the end of the last changed month is what it was, the later months
stand; else they are redone too. Everything a run changes is switched to by one
commit record (``sources.commits``), which also holds the calendar's bounds.

A feature is stored from the month in which a run first met it. Its days before
that are 0, as in the full build, and are added when the series are read, so a
new feature does not touch earlier months. A feature that has had no count by the
last day (its counts went) is not in the result.

Defined cases: cells are sparse counts, one row per ``feature`` and ``day``; null
counts are as good as absent; without any counts there is no store, and reading
gives no rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymatrix.operators.timeseries import bounds, day_sequence, densify_long, fill_series
from daymatrix.session import written
from daymatrix.sources import commits
from daymatrix.sources.store import drop_partitions, partition_values

PERIOD, RUN = "period", "run"
CELLS = "feature STRING, day DATE, n BIGINT, seen BOOLEAN, first DATE, period DATE"


def _month(day: dt.date) -> dt.date:
    return day.replace(day=1)


def _next_month(day: dt.date) -> dt.date:
    return (_month(day) + dt.timedelta(days=32)).replace(day=1)


def _months(lo: dt.date, hi: dt.date) -> list[dt.date]:
    out, m = [], _month(lo)
    while m <= hi:
        out.append(m)
        m = _next_month(m)
    return out


def _read(spark: SparkSession, path: str, months: dict[str, int]) -> DataFrame:
    if not months:
        return spark.createDataFrame([], CELLS)
    return spark.read.schema(CELLS).option("basePath", path).parquet(*[f"{path}/{RUN}={r}/{PERIOD}={m}" for m, r in months.items()])


def _state(spark: SparkSession, path: str, extra: dict, month: dt.date) -> DataFrame:
    """``feature, n, seen, first`` at the end of ``month``: each feature's last
    value, and whether it has had a count by then."""
    months = {m: r for m, r in extra.get("months", {}).items() if m == month.isoformat()}
    last = min(_next_month(month) - dt.timedelta(days=1), dt.date.fromisoformat(extra["hi"])) if months else month
    return _read(spark, path, months).where(F.col("day") == F.lit(last)).select("feature", "n", "seen", "first")


def _filled(spark: SparkSession, path: str, extra: dict, counts: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Filled cells of the days ``[start, end]``, from the state before and the
    counts within. A feature without a count so far is carried on as such."""
    before = start - dt.timedelta(days=1)
    state = _state(spark, path, extra, _month(before))
    seeds = state.select("feature", F.lit(before).alias("day"), F.when(F.col("seen"), F.col("n")).alias("n"))
    within = counts.where(F.col("day").between(F.lit(start), F.lit(end)) & F.col("n").isNotNull()).select("feature", "day", F.col("n").cast("long").alias("n"))
    grid = densify_long(seeds.unionByName(within), ["feature"], "day", "n", before, end, fill=None)
    filled = fill_series(grid, ["feature"], "day", "n", "ffill", zero_fill=False).where(F.col("day") >= F.lit(start))
    # A feature that the state does not know is stored from here on.
    return filled.join(state.select("feature", "first"), "feature", "left").select(
        "feature", "day", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.col("n").isNotNull().alias("seen"),
        F.coalesce("first", F.lit(start)).alias("first"), F.trunc("day", "MM").alias(PERIOD))


def _same(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def update(counts: DataFrame, path: str, changed_from: dt.date | None = None, changed_to: dt.date | None = None) -> list[dt.date]:
    """Bring the store at ``path`` up to date with ``counts`` (``feature, day,
    n``), of which only days in ``[changed_from, changed_to]`` differ from the run
    before (default: all days, all later days). Returns the months redone."""
    spark = counts.sparkSession
    seen = commits.snapshot(spark, path)
    extra = seen.extra
    lo, hi = bounds(counts.where("n IS NOT NULL"), "day")
    if lo is None:
        if extra.get("months"):
            commits.commit(spark, path, lambda now: ([], {}))
        return []
    known = extra.get("months", {})
    start = _month(max(changed_from or lo, lo))
    if known:
        was_lo, was_hi = (dt.date.fromisoformat(extra[k]) for k in ("lo", "hi"))
        if lo != was_lo:
            start = _month(min(lo, was_lo))  # another first day: every month counts from it
        if hi != was_hi:
            start = min(start, _month(min(hi, was_hi)))  # the month that was, or is now, cut short
    start = lo if not known or start <= lo else start
    stop = min(changed_to, hi) if changed_to is not None and known and hi == dt.date.fromisoformat(extra["hi"]) else hi
    end = min(_next_month(stop) - dt.timedelta(days=1), hi)
    run = commits.claim(spark, path)
    folder = f"{path}/{RUN}={run}"

    def build(first: dt.date, last: dt.date, base: dict) -> dict:
        # Nothing comes before the first day, whatever was stored.
        cells = _filled(spark, path, base if first > lo else {}, counts, first, last)
        cells.hint("rebalance", PERIOD).write.mode("append").partitionBy(PERIOD).parquet(folder)
        months = {m.isoformat(): run for m in _months(first, last)}
        # What lies before the first day or after the last one is no longer a month of the store.
        kept = {m: r for m, r in {**base.get("months", {}), **months}.items() if _month(lo).isoformat() <= m <= hi.isoformat()}
        return {"months": kept, "lo": lo.isoformat(), "hi": hi.isoformat()}

    new = build(start, end, extra)
    if end < hi and not _same(_state(spark, path, extra, _month(end)), _state(spark, path, new, _month(end))):
        new = build(end + dt.timedelta(days=1), hi, new)
        end = hi

    def change(now: commits.Snapshot):
        if now.version != seen.version:
            raise commits.CommitConflict("another run came first")
        return [], new

    commits.commit(spark, path, change)
    return _months(start, end)


def read_filled(spark: SparkSession, path: str) -> DataFrame:
    """``feature, day, n`` of every feature on every day."""
    extra = commits.snapshot(spark, path).extra
    months = extra.get("months", {})
    if not months:
        return _read(spark, path, {}).select("feature", "day", "n")
    lo, hi = (dt.date.fromisoformat(extra[k]) for k in ("lo", "hi"))
    live = written(_state(spark, path, extra, _month(hi)).where("seen").select("feature", "first"), "filled-features")
    cells = _read(spark, path, months).select("feature", "day", "n").join(live, "feature").where("day >= first").select("feature", "day", "n")
    early = live.where(F.col("first") > F.lit(lo)).select(
        "feature", F.explode(day_sequence(F.lit(lo), F.date_sub("first", 1))).alias("day"), F.lit(0).cast("long").alias("n"))
    return cells.unionByName(early)


def vacuum(spark: SparkSession, path: str) -> list[int]:
    """Delete the folders of runs that no month of the store comes from."""
    used = set(commits.snapshot(spark, path).extra.get("months", {}).values())
    dead = [r for r in map(int, partition_values(spark, path, RUN)) if r not in used]
    drop_partitions(spark, path, RUN, [str(r) for r in dead])
    return dead

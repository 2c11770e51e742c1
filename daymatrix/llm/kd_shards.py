"""K-d tree partitioning of documents into shards of nearly equal bytes.

A node of the tree holds documents and a number of leaves still to make. It is
split along its widest dimension (the one with the largest byte-weighted spread
against that of all documents) at the weighted quantile that gives each side
its share of the leaves. The quantile is found for all nodes of a level at once
by histograms that narrow down to the cell holding it; one row per node, the
cell that holds its quantile, reaches the driver. Splitting ends when leaves
hold the target bytes.

The dimensions are functions of the text (size, share of blanks, lines), and a
checksum of the text breaks ties, so equal texts have equal coordinates and
stay in one shard; only a group that outweighs the tolerance is cut, by a hash
of the ids. Everything is DataFrame work.

Defined cases: a null text has size 1 and checksum 0; a null id is hashed like
any other value; repeated rows count each; an empty table gives an empty
result; fewer rows than shards leave shards empty.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymatrix.llm.common import BROADCAST_KEYS, written

#: Cells of a histogram pass (a power of two).
CELL_BITS = 10
#: A cut may miss its quantile by this share of the node's bytes.
TOLERANCE = 0.002
KEY_BITS = 63


def dimensions() -> dict[str, Column]:
    """The default metadata dimensions of a document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    chars = F.length(text)
    return {
        "size": F.ln(F.octet_length(text) + F.lit(1.0)),
        "blanks": F.when(chars > 0, (chars - F.length(F.replace(text, F.lit(" "), F.lit("")))) / chars).otherwise(0.0),
        "lines": F.ln(chars - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + F.lit(1.0)),
    }


@dataclass
class Node:
    first: int
    leaves: int
    dim: int = 0
    low: int = 0
    shift: int = KEY_BITS - CELL_BITS
    under: int = 0
    total: int = 0
    cut: int | None = None
    share: float = 0.0


def digest(docs: DataFrame, dims: dict[str, Column]) -> DataFrame:
    """``doc_id, size, text_crc32, h, d0, d1, ...`` for every row."""
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / F.lit(float(1 << 31))).alias("h"),
        *(c.cast("double").alias(f"d{i}") for i, c in enumerate(dims.values())),
    )


def _keyed(rows: DataFrame, n_dims: int) -> tuple[DataFrame, list[float], int]:
    """Each dimension as a 63-bit key: the coordinate on 31 bits, then the
    text's checksum. Also the spread of each dimension, and all bytes."""
    aggs = [F.sum("size").alias("total")]
    for i in range(n_dims):
        aggs += [F.min(f"d{i}").alias(f"lo{i}"), F.max(f"d{i}").alias(f"hi{i}"), *_moments(i)]
    s = rows.agg(*aggs).first()
    if not s["total"]:
        return rows, [], 0
    keys = []
    for i in range(n_dims):
        width = (s[f"hi{i}"] - s[f"lo{i}"]) or 1.0
        place = F.floor((F.col(f"d{i}") - s[f"lo{i}"]) / width * float((1 << 31) - 1)).cast("long")
        keys.append(F.shiftleft(place, 32).bitwiseOR(F.col("text_crc32")).alias(f"k{i}"))
    return rows.select("*", *keys), [max(_spread(s, i), 1e-12) for i in range(n_dims)], s["total"]


def _moments(i: int) -> list[Column]:
    d, w = F.col(f"d{i}"), F.col("size").cast("double")
    return [F.sum(d * w).alias(f"s{i}"), F.sum(d * d * w).alias(f"q{i}")]


def _spread(row, i: int) -> float:
    mean = row[f"s{i}"] / row["total"]
    return max(row[f"q{i}"] / row["total"] - mean * mean, 0.0) ** 0.5


def _for_nodes(rows: DataFrame, values: list[dict], schema: str) -> DataFrame:
    """``rows`` with one row of ``values`` for each node; a long list is joined
    by a shuffle."""
    table = rows.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(values)), f"array<struct<{schema}>>")))
    return rows.join(F.broadcast(table) if len(values) <= BROADCAST_KEYS else table, "node", "left")


def _along(n_dims: int) -> Column:
    key = F.col("k0")
    for i in range(1, n_dims):
        key = F.when(F.col("dim") == i, F.col(f"k{i}")).otherwise(key)
    return key


def _find_cuts(rows: DataFrame, nodes: list[Node], n_dims: int) -> None:
    """Set ``cut`` (and ``share``, where one key must itself be divided)."""
    below = Window.partitionBy("node").orderBy("cell")  # at most 2^CELL_BITS rows a node
    while open_nodes := [n for n in nodes if n.cut is None]:
        steps = [{"node": n.first, "dim": n.dim, "low": n.low, "shift": n.shift, "under": n.under,
                  "goal": n.total * (n.leaves // 2) / n.leaves} for n in open_nodes]
        keyed = _for_nodes(rows, steps, "node: int, dim: int, low: bigint, shift: int, under: bigint, goal: double").where("dim IS NOT NULL")
        cells = (
            keyed.withColumn("key", _along(n_dims)).where(F.col("key") >= F.col("low"))
            .withColumn("cell", F.expr("shiftright(key - low, shift)")).where(F.col("cell") < (1 << CELL_BITS))
            .groupBy("node", "cell", "under", "goal").agg(F.sum("size").alias("bytes"))
            .withColumn("upto", F.col("under") + F.sum("bytes").over(below))
        )
        reached = F.when(F.col("upto") >= F.col("goal"), F.struct("cell", "bytes", (F.col("upto") - F.col("bytes")).alias("under")))
        found = {r["node"]: r for r in cells.groupBy("node").agg(
            F.min(reached).alias("hit"), F.max(F.struct("cell", "upto")).alias("end")).collect()}  # one row per node
        for n, goal in zip(open_nodes, (s["goal"] for s in steps)):
            row = found.get(n.first)
            if row is None:
                last, size, under = 0, 0, n.under
            elif row["hit"] is None:
                last, size, under = row["end"]["cell"], 0, row["end"]["upto"]
            else:
                last, size, under = row["hit"]["cell"], row["hit"]["bytes"], row["hit"]["under"]
            if size <= TOLERANCE * n.total or (n.shift == 0 and size <= 2 * TOLERANCE * n.total):
                n.cut = n.low + ((last + (goal - under > size / 2)) << n.shift)
            elif n.shift == 0:
                n.cut, n.share = n.low + last, (goal - under) / size
            else:
                n.low, n.under = n.low + (last << n.shift), under
                n.shift = max(0, n.shift - CELL_BITS)


def kd_shards(docs: DataFrame, n_shards: int | None = 8, target_bytes: int | None = None, dims: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``
    (``doc_id``, ``text`` and what ``dims`` uses). Give the number of leaves,
    or the bytes that a leaf should hold."""
    dims = dims or dimensions()
    rows, spread, total = _keyed(written(digest(docs, dims), "kd-digest"), len(dims))
    if not total:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).limit(0)
    leaves = n_shards if target_bytes is None else max(1, -(-total // target_bytes))
    done, level = [], [Node(0, leaves)]
    rows = rows.withColumn("node", F.lit(0))
    while level := [n for n in level if n.leaves > 1]:
        stats = {r["node"]: r for r in rows.groupBy("node").agg(
            F.sum("size").alias("total"), *(m for i in range(len(dims)) for m in _moments(i))).collect()}
        done = []
        for n in level:
            s = stats.get(n.first)
            if s is None:
                n.cut = 0
                continue
            n.total = s["total"]
            n.dim = max(range(len(dims)), key=lambda i: _spread(s, i) / spread[i])
        _find_cuts(rows, level, len(dims))
        cuts = [{"node": n.first, "dim": n.dim, "cut": n.cut, "share": n.share, "above": n.first + n.leaves // 2} for n in level]
        rows = (
            _for_nodes(rows, cuts, "node: int, dim: int, cut: bigint, share: double, above: int").withColumn("key", _along(len(dims)))
            .withColumn("node", F.when(F.col("cut").isNull() | (F.col("key") < F.col("cut")) | ((F.col("key") == F.col("cut")) & (F.col("h") < F.col("share"))), F.col("node"))
                        .otherwise(F.col("above")))
            .drop("dim", "cut", "share", "above", "key")
        )
        for n in level:
            done += [Node(n.first, n.leaves // 2), Node(n.first + n.leaves // 2, n.leaves - n.leaves // 2)]
        level = done
    return _numbered(rows.select("doc_id", "size", "text_crc32", F.col("node").alias("shard")))


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``slot``: 0, 1, ... within each shard, ordered by id. Rows are
    sorted over all tasks, numbered within each, and shifted by what the tasks
    before hold of the shard."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(
        rows.repartitionByRange(n, "shard", "doc_id", "text_crc32").sortWithinPartitions("shard", "doc_id", "text_crc32")
        .withColumn("at", F.monotonically_increasing_id()).withColumn("task", F.shiftright("at", 33)), "kd-placed")
    parts = placed.groupBy("shard", "task").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offset = parts.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))).select("shard", "task", "first", "skip")
    return placed.join(offset, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first") + F.col("skip")).alias("slot"))

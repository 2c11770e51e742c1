"""Prefix trie of rebuilt conversations, from composable fingerprints.

A rebuilt conversation is the head of its base conversation followed by its own
turns from there on. No rebuilt text is made. A sequence of turns has the
fingerprint (length n, sum of x_i * B^i mod 2^64) in two lanes, x_i the hashes of
turn i; sequences compose as ``(n, s) * (m, t) = (n + m, s + B^n * t)``. With the
sums of every original prefix at hand, the prefix of a rebuilt conversation that
takes h turns of its base and goes on with own turns h..p is

    base[h] + B^(h' - h) * (own[p] - own[h])      (h' the turns the base has)

(B is odd, so its negative powers exist). Only references to turns (conversation
and position), their hashes and their lengths travel.

Nodes are the groups of equal depth and fingerprint. Each group verifies that its
members refer to turns of one kind and come from one parent group; kinds of
turns are checked against the stored turns (equal hashes must mean equal role and
text). By induction over the depth every node then holds one sequence. A clash
raises instead of merging two sequences.

Sums over subtrees need no walk along the depth. A node's own amount is booked on
its smallest member; that conversation passes through all nodes above it, so a
node's subtree holds what is booked on its members, less what its smallest member
has booked at lesser depths. Running sums (positions, prefix sums, bookings) are
made in range partitions and composed over partitions, so a conversation of any
length is spread over tasks. The hash of a node's end ids is made of pieces in
order; it is one sequential hash by definition, of which only short pieces meet
in a task, in bounded memory.

Defined cases: null role or text counts as empty; turns are ordered with null
first, ties by role and then by a hash of the text; repeated rows are turns like
any others; rows without ``conv_id`` belong to no conversation; ``c - c % 100``
rounds towards zero; an empty table has no node, not even a root; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymatrix.llm.common import written

BASE_EVERY = 100
HEADS = 6          # a head has 0 to 5 turns
B = 0x9E3779B97F4A7C15
LANES = ("x", "y")
#: Bytes of joined ids in one piece.
PIECE = 1 << 15
NO_ENDS = hashlib.sha256(b"").hexdigest()


def power(base: int, n: np.ndarray) -> np.ndarray:
    """``base ** n`` mod 2^64 for whole numbers ``n >= 0``."""
    n = n.astype(np.uint64)
    out, square = np.ones(len(n), np.uint64), np.uint64(base)
    for bit in range(64):
        if not (n >> np.uint64(bit)).any():
            break
        out = np.where((n >> np.uint64(bit)) & np.uint64(1), out * square, out)
        square = np.uint64(int(square) * int(square) & (1 << 64) - 1)
    return out


def _u(a) -> np.ndarray:
    return a.to_numpy(zero_copy_only=False).view(np.uint64)


def _with(batch: pa.RecordBatch, more: dict[str, np.ndarray]) -> pa.RecordBatch:
    cols = {n: batch[n] for n in batch.schema.names} | {k: pa.array(v.view(np.int64), pa.int64()) for k, v in more.items()}
    return pa.RecordBatch.from_pydict(cols)


def running(df: DataFrame, key: str, order: Sequence[str], lanes: Sequence[str], base: int) -> DataFrame:
    """``df`` with ``pos`` (rows before it under the same ``key``, by ``order``)
    and for every lane ``<lane>_before`` and ``<lane>_after``: the sum of
    ``lane * base ** pos`` (mod 2^64) over the rows before it, and with it. The
    rows of one key may fill many partitions."""
    columns = df.columns
    schema = T.StructType(df.schema.fields + [T.StructField(c, T.LongType()) for c in ("part", "at", *(f"{x}_sum" for x in lanes))])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n0, sums = TaskContext.get().partitionId(), None, 0, [0] * len(lanes)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch[key].to_numpy()
            new = np.concatenate([[last is None or keys[0] != last], keys[1:] != keys[:-1]])
            start = np.flatnonzero(new)
            of = np.cumsum(new)  # 0: goes on from the batch before
            begin = np.concatenate([[0], start])[of]
            at = np.arange(n) - begin + np.where(of == 0, n0, 0)
            out = {"part": np.full(n, part, np.int64), "at": at.astype(np.int64)}
            for i, lane in enumerate(lanes):
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_u(batch[lane]) * power(base, at), dtype=np.uint64)])
                with np.errstate(over="ignore"):
                    out[f"{lane}_sum"] = total[:-1] - total[begin] + np.where(of == 0, np.uint64(sums[i]), np.uint64(0))
                    sums[i] = int(total[-1] - total[begin[-1]] + np.uint64(sums[i] if of[-1] == 0 else 0))
            last, n0 = keys[-1], int(at[-1]) + 1
            yield _with(batch, out)

    def follow(pieces):
        pieces, n, sums = pieces.sort_values("part"), 0, [0] * len(lanes)
        out = {c: [] for c in ("part", "n0", *(f"{x}_0" for x in lanes))}
        for row in pieces.itertuples(index=False):
            for c, v in zip(out, (row.part, n, *sums)):
                out[c].append(v)
            up = pow(base, n, 1 << 64)
            sums = [(s + up * int(getattr(row, f"{x}_all"))) % (1 << 64) for s, x in zip(sums, lanes)]
            n += int(row.n)
        frame = {c: np.array(v, np.uint64).view(np.int64) for c, v in out.items()}
        return pd.DataFrame({key: pieces[key].to_numpy(), **frame})

    ranged = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    rows = written(ranged.mapInArrow(local, schema), "running")
    spread = rows.groupBy(key).agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select(key)
    # Keys that go on over a partition's end: no more than there are partitions.
    last = F.struct("at", *(f"{x}_sum" for x in lanes), *lanes)
    pieces = rows.join(F.broadcast(spread), key, "left_semi").groupBy(key, "part").agg(F.count("*").alias("n"), F.max(last).alias("l"))
    with_last = pieces.select(key, "part", "n", "l").mapInArrow(_piece_total(key, lanes, base), f"{key} long, part long, n long, " + ", ".join(f"{x}_all long" for x in lanes))
    carry = with_last.groupBy(key).applyInPandas(follow, f"{key} long, part long, n0 long, " + ", ".join(f"{x}_0 long" for x in lanes))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n0 = batch["n0"].to_numpy(zero_copy_only=False)
            up, pos = power(base, n0), n0 + batch["at"].to_numpy()
            out = {"pos": pos}
            for lane in lanes:
                before = _u(batch[f"{lane}_0"]) + up * _u(batch[f"{lane}_sum"])
                out[f"{lane}_before"], out[f"{lane}_after"] = before, before + power(base, pos) * _u(batch[lane])
            yield _with(batch.select(columns), out)

    done = T.StructType(df.schema.fields + [T.StructField(c, T.LongType()) for c in ("pos", *(f"{x}_{s}" for x in lanes for s in ("before", "after")))])
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n0", *(f"{x}_0" for x in lanes))}
    return rows.join(F.broadcast(carry), [key, "part"], "left").withColumns(zero).mapInArrow(finish, done)


def _piece_total(key: str, lanes: Sequence[str], base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch["l"]
            up = power(base, last.field("at").to_numpy())
            out = {f"{x}_all": _u(last.field(f"{x}_sum")) + up * _u(last.field(x)) for x in lanes}
            yield _with(batch.select([key, "part", "n"]), out)

    return run


def _turns(conversations: DataFrame) -> DataFrame:
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.select(
        "conv_id", "turn", "role", "text", F.length("text").cast("long").alias("chars"),
        F.xxhash64(F.length("role"), "role", "text").alias("x"), F.xxhash64("text", F.length("text"), "role").alias("y"))


def _check_kinds(turns: DataFrame) -> None:
    """Raise if two different turns have the same hashes."""
    kinds = turns.select("x", "y", "role", "text").distinct()
    if kinds.groupBy("x", "y").count().where("count > 1").limit(1).count():
        raise RuntimeError("two different turns have the same hashes")


def _own_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of prefixes that end in an own turn, and of those one turn
    shorter, from sums of the base's head and of the own turns."""
    inverse = pow(B, -1, 1 << 64)
    for batch in batches:
        h, h1, pos = (batch[c].to_numpy() for c in ("h", "h1", "pos"))
        shift = power(inverse, h - h1)
        out = {"depth": h1 + pos - h + 1}
        for lane, f, p in (("x", "f1", "p1"), ("y", "f2", "p2")):
            own, base = _u(batch[f"own_{lane}"]), _u(batch[f"base_{lane}"])
            out[f] = base + shift * (_u(batch[f"{lane}_after"]) - own)
            out[p] = base + shift * (_u(batch[f"{lane}_before"]) - own)
        out["ends"] = (pos == batch["n"].to_numpy() - 1).astype(np.int64)
        yield _with(batch.select(["conv_id", "x", "y", "chars"]), out)


MEMBER = ["conv_id", "depth", "f1", "f2", "p1", "p2", "x", "y", "chars", "ends"]


def members(conversations: DataFrame) -> DataFrame:
    """One row for every rebuilt conversation and depth from 0 to its length:
    fingerprint of the prefix (``f1, f2``) and of the one above (``p1, p2``),
    hashes and code points of its last turn, and whether it ends there."""
    raw = _turns(conversations)
    _check_kinds(raw)
    turns = written(running(raw.drop("text"), "conv_id", ["turn", "role", "x"], LANES, B), "trie-turns")
    item = F.struct("pos", "x", "y", "chars", "x_before", "y_before", "x_after", "y_after")
    heads = written(turns.groupBy("conv_id").agg(
        (F.max("pos") + 1).alias("n"), F.sort_array(F.collect_list(F.when(F.col("pos") < HEADS - 1, item))).alias("head")), "trie-heads")
    base = heads.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    sums = {f"{kind}_{x}": F.expr(f"if({k} = 0, 0L, {head}[int({k}) - 1].{x}_after)") for kind, head, k in (("base", "base_head", "h1"), ("own", "head", "least(h, n)")) for x in LANES}
    convs = (
        heads.withColumn("h", F.expr(f"crc32(cast(conv_id AS string)) % {HEADS}")).withColumn("base", F.expr(f"conv_id - conv_id % {BASE_EVERY}"))
        .join(base, "base", "left").withColumn("base_head", F.expr("coalesce(base_head, slice(head, 1, 0))"))
        .withColumn("h1", F.expr("least(h, size(base_head)) + 0L")).withColumns(sums)
    )
    convs = written(convs, "trie-conversations")
    zeros = [F.lit(0).cast("long").alias(c) for c in MEMBER[2:9]]
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), *zeros, F.expr("int(h1 = 0 AND n <= h) + 0L").alias("ends"))
    head = (
        convs.select("conv_id", "h", "h1", "n", F.explode(F.expr("slice(base_head, 1, int(h1))")).alias("t"))
        .select("conv_id", (F.col("t.pos") + 1).alias("depth"), F.col("t.x_after").alias("f1"), F.col("t.y_after").alias("f2"),
                F.col("t.x_before").alias("p1"), F.col("t.y_before").alias("p2"), "t.x", "t.y", "t.chars",
                F.expr("int(t.pos = h1 - 1 AND n <= h) + 0L").alias("ends"))
    )
    own = turns.join(convs.select("conv_id", "n", "h", "h1", *sums), "conv_id").where("pos >= h").mapInArrow(
        _own_members, "conv_id long, x long, y long, chars long, depth long, f1 long, p1 long, f2 long, p2 long, ends long")
    return written(root.unionByName(head).unionByName(own).select(*MEMBER), "trie-members")


NODE = ["depth", "f1", "f2"]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of sorted ``(node, conv_id)`` rows joined into short pieces."""
    node, ids, size = None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({**{c: pa.array([v], pa.int64()) for c, v in zip(NODE, node)}, "first": pa.array([ids[0]], pa.int64()),
                                           "piece": pa.array([",".join(map(str, ids))], pa.string())})

    for batch in batches:
        for *here, conv in zip(*(batch[c].to_pylist() for c in (*NODE, "conv_id"))):
            if here != node or size > PIECE:
                if ids:
                    yield piece()
                node, ids, size = here, [], 0
            ids.append(conv)
            size += 20
    if ids:
        yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, sha, done = None, None, []

    def rows(found: list) -> pa.RecordBatch:
        cols = list(zip(*found)) or [[]] * 4
        return pa.RecordBatch.from_pydict({**{c: pa.array(v, pa.int64()) for c, v in zip(NODE, cols)}, "ends_sha256": pa.array(cols[3], pa.string())})

    for batch in batches:
        for *here, piece in zip(*(batch[c].to_pylist() for c in (*NODE, "piece"))):
            if here != node:
                if sha:
                    done.append((*node, sha.hexdigest()))
                node, sha = here, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(piece.encode())
        yield rows(done)
        done = []
    if sha:
        yield rows([(*node, sha.hexdigest())])


def end_hashes(rows: DataFrame) -> DataFrame:
    """``depth, f1, f2, ends_sha256`` of nodes at which conversations end. Range
    partitions over node and id join the ids; a node's pieces then meet."""
    ends = rows.where("ends = 1").select(*NODE, "conv_id")
    return (
        ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
        .mapInArrow(_pieces, "depth long, f1 long, f2 long, first long, piece string")
        .repartition(*NODE).sortWithinPartitions(*NODE, "first")
        .mapInArrow(_digests, "depth long, f1 long, f2 long, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` per node."""
    rows = members(conversations)
    same = ["p1", "p2", "x", "y"]
    nodes = written(rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"),
        *(f(c).alias(f"{n}_{c}") for c in same for n, f in (("lo", F.min), ("hi", F.max)))), "trie-groups")
    if nodes.where(" OR ".join(f"lo_{c} <> hi_{c}" for c in same)).limit(1).count():
        raise RuntimeError("two different prefixes have the same fingerprint")
    above = [(F.col("depth") - 1).alias("depth"), F.col("lo_p1").alias("f1"), F.col("lo_p2").alias("f2")]
    children = nodes.where("depth > 0").select(*above).groupBy(*NODE).agg(F.count("*").alias("n_children"))
    nodes = written(
        nodes.select(*NODE, "conv_id", "n_convs", "lo_p1", "lo_p2", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
        .join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")
    booked = nodes.groupBy("conv_id").agg(F.sum("saved").alias("booked"), F.sum(F.expr("int(n_children = 0)")).alias("leaf"))
    below = rows.join(booked, "conv_id").groupBy(*NODE).agg(F.sum("booked").alias("below"), F.sum("leaf").alias("n_leaves"))
    lesser = running(nodes.select("conv_id", *NODE, "saved"), "conv_id", ["depth"], ["saved"], 1).select(*NODE, "saved_before")
    parent = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("lo_p1"), F.col("f2").alias("lo_p2"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(below, NODE).join(lesser, NODE).join(end_hashes(rows), NODE, "left").join(parent, ["depth", "lo_p1", "lo_p2"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                (F.col("below") - F.col("saved_before")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    )


#: The same in DuckDB, from whole rebuilt prefixes. The CRC-32 is worked out bit
#: by bit over the decimal digits.
ORACLE = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % {BASE_EVERY} AS base,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda q, z: xor(q >> 1, 3988292384::BIGINT * (q & 1)))), 4294967295::BIGINT) % {HEADS} AS h
    FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, t.pos + 1 AS depth, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + t.pos - c.h + 1, t.role, t.text
    FROM c JOIN t USING (conv_id) LEFT JOIN c b ON b.conv_id = c.base WHERE t.pos >= c.h),
p AS (SELECT conv_id, depth, text, list(struct_pack(role := role, text := text)) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
    UNION ALL SELECT conv_id, 0, '', [] FROM c),
e AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
m AS (SELECT p.*, p.depth = e.depth AS ends FROM p JOIN e USING (conv_id)),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(length(text)) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM m GROUP BY path, depth),
kids AS (SELECT path[:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (path, depth)),
sub AS (SELECT m.path, m.depth, sum(w.saved) AS saved_tokens, sum((w.n_children = 0)::INT) AS n_leaves
    FROM full_nodes w JOIN m ON m.conv_id = w.conv_id AND m.depth <= w.depth GROUP BY ALL)
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sub s ON s.path = f.path AND s.depth = f.depth
LEFT JOIN full_nodes u ON u.depth = f.depth - 1 AND u.path = f.path[:f.depth - 1]"""

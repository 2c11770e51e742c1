"""Counting keys over all documents without a row per occurrence.

Some operators ask of every word, shingle or window of the corpus how often
it occurs in all documents, and need the answer back where the text is. A
plain join ships one row per occurrence both ways. Here documents travel in
blocks of a few MB:

1. ``pack`` cuts the scan into blocks; where they must travel, each is one row
   with its documents as compressed Arrow data;
2. ``count_keys`` reduces each block to its distinct 48-bit keys, dealt by
   their leading bits into buckets as sorted, delta-coded arrays (a few bytes
   a key); a bucket, one group of a shuffle, adds up the counts over all
   blocks and returns to each block the totals in the order of its own keys;
3. ``with_counts`` brings a block and its totals together again.

A key occurs once per block, so a very frequent key weighs no more than one
row per block, and every group holds an even share of the key space. Block
ids name the partition, the position in it and the content, so a recomputed
task yields the same ids; if the input changed between the two scans (a
non-deterministic plan), the step raises instead of mixing them up.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a block; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20
KEY_BITS = 48
_IPC = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):
    def _trim(_):
        return 0


def release() -> None:
    """Give free memory back to the system. Python workers live on from stage to
    stage, and what their allocators keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def table_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=_IPC) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def bytes_table(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def bucket_bits(docs: DataFrame) -> int:
    """Buckets follow the number of input partitions, so that a bucket's share
    of the keys stays about the same at any input size."""
    return max(6, min(20, (4 * docs.rdd.getNumPartitions() - 1).bit_length()))


def cut(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.Table]:
    """The rows of a partition, in order, in tables of about ``limit`` bytes."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        weight = np.cumsum(16 + np.nan_to_num(pc.binary_length(table[text]).to_numpy(zero_copy_only=False).astype(float)))
        lo, base = 0, 0.0
        while lo < len(table):
            hi = max(lo + 1, int(np.searchsorted(weight, base + limit - size, "right")))
            hi = min(hi, len(table))
            held.append(table.slice(lo, hi - lo))
            size += weight[hi - 1] - base
            lo, base = hi, weight[hi - 1]
            if size >= limit or lo < len(table):
                yield pa.concat_tables(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _name(table: pa.Table, part: int, seq: int) -> int:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    digest = hashlib.blake2b(sink.getvalue(), digest_size=8, salt=f"{part}.{seq}".encode()[:16]).digest()
    return int.from_bytes(digest, "little", signed=True)


@dataclass(frozen=True)
class Blocks:
    """The given columns of all documents, cut into blocks."""

    docs: DataFrame
    columns: list[str]
    text: str
    limit: int

    def map(self, fn: Callable[[int, pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
        """``fn(block, documents)`` of every block, in the task that cuts it: one
        Python process per task, and no packing on the way."""
        text, limit = self.text, self.limit

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            for seq, table in enumerate(cut(batches, text, limit)):
                yield fn(_name(table, part, seq), table)
                del table
                release()

        return self.docs.select(*self.columns).mapInArrow(run, schema)

    def packed(self) -> DataFrame:
        """``(block, payload)`` rows."""

        def payload(block: int, table: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "payload": pa.array([table_bytes(table)], pa.binary())})

        return self.map(payload, "block long, payload binary")


def pack(docs: DataFrame, columns: list[str], text: str = "text", limit: int = BLOCK_BYTES) -> Blocks:
    return Blocks(docs, columns, text, limit)


def pack_ints(values: np.ndarray, width: int) -> bytes:
    """Unsigned integers as compressed byte planes (equal planes cost nothing)."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return zstandard.compress(np.ascontiguousarray(planes.T).tobytes(), 1)


def unpack_ints(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def distinct_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct 48-bit keys, the position of each key among them, and
    their counts."""
    return np.unique(keys >> np.uint64(64 - KEY_BITS), return_inverse=True, return_counts=True)


def bucket_edges(keys: np.ndarray, bits: int) -> np.ndarray:
    return np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(KEY_BITS - bits)).tolist() + [len(keys)]


def count_keys(blocks: Blocks, keys_of: Callable[[pa.Table], np.ndarray], bits: int) -> DataFrame:
    """``(block, bucket, payload)``: the corpus-wide counts of each block's
    distinct keys. ``keys_of`` gives the 64-bit keys of a block's documents,
    one for each occurrence that counts."""

    def emit(block: int, docs: pa.Table) -> pa.RecordBatch:
        keys, _, counts = distinct_keys(keys_of(docs))
        edges = bucket_edges(keys, bits)
        rows = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]
        return pa.RecordBatch.from_pydict({
            "block": pa.array([block] * len(rows), pa.int64()),
            "bucket": pa.array([b for b, _, _ in rows], pa.int32()),
            "keys": pa.array([pack_ints(np.diff(keys[lo:hi], prepend=np.uint64(0)), 6) for _, lo, hi in rows], pa.binary()),
            "counts": pa.array([pack_ints(counts[lo:hi], 4) for _, lo, hi in rows], pa.binary()),
        })

    def add(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keys = [np.cumsum(unpack_ints(x.as_py(), 6)) for x in table["keys"]]
        counts = np.concatenate([unpack_ints(x.as_py(), 4) for x in table["counts"]])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, at, counts.astype(np.int64))
        total = np.minimum(total[at], (1 << 32) - 1)
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        return pa.table({
            "block": table["block"], "bucket": table["bucket"],
            "payload": pa.array([pack_ints(x, 4) for x in np.split(total, cuts)], pa.binary()),
        })

    return (
        blocks.map(emit, "block long, bucket int, keys binary, counts binary")
        .groupBy("bucket").applyInArrow(add, "block long, bucket int, payload binary")
    )


def meet(blocks: Blocks, parts: DataFrame, fn: Callable[[pa.Table, list[tuple[int, bytes]]], pa.Table], schema: str) -> DataFrame:
    """Bring each block together with its ``(bucket, payload)`` rows and apply
    ``fn(documents, rows in bucket order)``."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["bucket"].to_pylist(), table["payload"].to_pylist()), key=lambda r: r[0])
        if [b for b, _ in rows].count(-1) != 1:
            raise RuntimeError("the input changed between two scans: write it to a table first")
        try:
            return fn(bytes_table(rows[0][1]), rows[1:])
        finally:
            release()

    both = blocks.packed().select("block", F.lit(-1).alias("bucket"), "payload").unionByName(parts)
    return both.groupBy("block").applyInArrow(run, schema)


def with_counts(blocks: Blocks, counts: DataFrame, keys_of: Callable[[pa.Table], np.ndarray],
                fn: Callable[[pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """``fn(documents, counts)`` for each block, where ``counts`` holds the
    corpus-wide count of every key that ``keys_of`` gives, in its order."""

    def run(docs: pa.Table, rows: list[tuple[int, bytes]]) -> pa.Table:
        total = np.concatenate([unpack_ints(x, 4) for _, x in rows]) if rows else np.zeros(0, np.uint64)
        keys, at, _ = distinct_keys(keys_of(docs))
        if len(keys) != len(total):
            raise RuntimeError("the input changed between two scans: write it to a table first")
        return fn(docs, total[at].astype(np.int64))

    return meet(blocks, counts, run, schema)

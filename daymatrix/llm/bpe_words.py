"""BPE encoding and decoding over a table of distinct words.

Texts are split into pre-tokens ("words") in Spark tasks. Every block of
documents sends its distinct words to buckets by hash; a bucket sees each
distinct word of the corpus once, encodes it once, and returns the ids to each
block in the order of the block's words. There the ids are joined back by
position. Decoding joins ids with the id-to-piece table of the vocabulary
(bounded by the vocabulary, so every task has it) and concatenates the bytes.

The ids equal those of the tokenizers library for whole texts, special tokens
in the text included; the vocabulary's content is a parameter.

Defined cases: a null text counts as empty and has no ids; repeated rows are
encoded like any others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from daymatrix.llm.blocks import bucket_bits, bytes_table, meet, pack, pack_ints, release, table_bytes, unpack_ints
from daymatrix.llm.pretokens import Pretokens, pieces, special_tokens, split_special, tokenizer

ENCODED = "doc_id long, ids array<int>"
#: Distinct words encoded at once.
SLICE = 10_000


def default_vocabulary() -> str:
    """Content of the public byte-level BPE vocabulary file."""
    import public_tokenizers

    return Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()


def _split(docs: pa.Table, special: list[str]) -> tuple[Pretokens, np.ndarray]:
    rows, whole, first = split_special(pc.fill_null(docs["text"], "").to_pylist(), special)
    tokens = Pretokens(rows, whole)
    return tokens, tokens.first[first]


def _edges(keys: np.ndarray, bits: int) -> list[int]:
    return np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() + [len(keys)]


def encode(docs: DataFrame, vocabulary: str, then: Callable[[pa.Table], pa.Table] | None = None, schema: str = ENCODED) -> DataFrame:
    """``doc_id, ids`` for every row of ``docs`` (``doc_id``, ``text``).

    ``then`` maps the encoded rows of a block to other rows within the same
    task (digests, say), so that ids need not travel further.
    """
    bits = bucket_bits(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    special = special_tokens(vocabulary)
    blocks = pack(docs, ["doc_id", "text"])

    def send(block: int, table: pa.Table) -> pa.RecordBatch:
        tokenizer(shared.value)  # its character classes hold for the splitting
        tokens, _ = _split(table, special)
        text, edges = pa.array(tokens.distinct(), pa.string()), _edges(tokens.keys, bits)
        rows = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]
        return pa.RecordBatch.from_pydict({
            "block": pa.array([block] * len(rows), pa.int64()), "bucket": pa.array([b for b, _, _ in rows], pa.int32()),
            "words": pa.array([table_bytes(pa.table({"w": text.slice(lo, hi - lo)})) for _, lo, hi in rows], pa.binary())})

    def encode_bucket(table: pa.Table) -> pa.Table:
        lists = [bytes_table(x.as_py())["w"].combine_chunks() for x in table["words"]]
        at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        coded = pa.chunked_array(lists, pa.string()).combine_chunks().dictionary_encode()
        del lists
        distinct, of = coded.dictionary, coded.indices.to_numpy()
        model, sizes, flats = tokenizer(shared.value), [], []
        for lo in range(0, len(distinct), SLICE):
            found = [e.ids for e in model.encode_batch_fast(distinct.slice(lo, SLICE).to_pylist(), add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            flats.append(np.fromiter((i for x in found for i in x), np.int64, int(sizes[-1].sum())))
        size, flat = np.concatenate(sizes), np.concatenate(flats)
        begin = np.cumsum(size) - size
        out = []
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
            word = of[lo:hi]
            n = size[word]
            own = np.repeat(begin[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out.append((hi - lo).to_bytes(4, "little") + pack_ints(np.concatenate([n, flat[own]]), 4))
        try:
            return pa.table({"block": table["block"], "bucket": table["bucket"], "payload": pa.array(out, pa.binary())})
        finally:
            release()

    def join_back(table: pa.Table, rows: list[tuple[int, bytes]]) -> pa.Table:
        tokenizer(shared.value)
        tokens, first = _split(table, special)
        sizes, flats = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, payload in rows:
            n, values = int.from_bytes(payload[:4], "little"), unpack_ints(payload[4:], 4).astype(np.int64)
            sizes.append(values[:n])
            flats.append(values[n:])
        size, flat = np.concatenate(sizes), np.concatenate(flats)
        if len(size) != len(tokens.keys):
            raise RuntimeError("the input changed between two scans: write it to a table first")
        begin = np.cumsum(size) - size
        n_ids = size[tokens.of]
        to = np.concatenate([[0], np.cumsum(n_ids)])
        at = np.repeat(begin[tokens.of] - to[:-1], n_ids) + np.arange(to[-1])
        ids = pa.ListArray.from_arrays(pa.array(to[first], pa.int32()), pa.array(flat[at].astype(np.int32)))
        out = pa.table({"doc_id": table["doc_id"], "ids": ids})
        return then(out) if then else out

    words = (
        blocks.map(send, "block long, bucket int, words binary")
        .groupBy("bucket").applyInArrow(encode_bucket, "block long, bucket int, payload binary")
    )
    return meet(blocks, words, join_back, schema)


def decode_table(ids: pa.ChunkedArray | pa.Array, piece: list[bytes]) -> list[str]:
    """Texts of id lists: ids joined with pieces, bytes read as UTF-8 with
    invalid ones replaced."""
    return [b"".join([piece[i] for i in row.tolist()]).decode("utf-8", "replace") for row in _rows(ids)]


def _rows(ids: pa.ChunkedArray | pa.Array):
    for part in ids.chunks if isinstance(ids, pa.ChunkedArray) else [ids]:
        off = part.offsets.to_numpy()
        flat = part.values.to_numpy()
        for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
            yield flat[a:b]


_PIECES: dict[int, list[bytes]] = {}


def _piece_table(vocabulary: str) -> list[bytes]:
    name = hash(vocabulary)
    if name not in _PIECES:
        _PIECES[name] = pieces(vocabulary)
    return _PIECES[name]


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "text": pa.array(decode_table(batch["ids"], _piece_table(shared.value)), pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``) of every
    document: encoded, then decoded again from the ids."""
    vocabulary = vocabulary or default_vocabulary()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def digest(table: pa.Table) -> pa.Table:
        ids = table["ids"]
        return pa.table({
            "doc_id": table["doc_id"],
            "n_tokens": pa.array([len(x) for x in _rows(ids)], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in _rows(ids)], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decode_table(ids, _piece_table(shared.value))], pa.string()),
            **({"ids": ids} if keep_ids else {}),
        })

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    return encode(docs.select("doc_id", "text"), vocabulary, digest, schema)

"""Passages that repeat across documents, by sparse suffix arrays.

Of all suffixes of a text (in words) only those are retained that start at a
minimiser: a position whose 8-word hash is the least among 20 neighbours. Any
passage of ``MIN_WORDS`` words has one within its first 20 words, at the same
place in every document that holds it, so its suffixes agree for at least
``RIGHT`` words. The retained suffixes of all documents are sorted by the
fingerprint of these words (dealt over tasks by its leading bits, see
``blocks``), and neighbours that agree mark the anchors of matches. From each
anchor the match is extended to the left, to every start that the minimiser
window allows, and to the right to the full length: the ``MIN_WORDS``-word
windows found there are compared over all documents once more, and those that
a second document holds are joined to maximal spans. The spans are exactly the
words covered by a window of ``MIN_WORDS`` words that another document has.

Words are runs of characters other than ASCII white space, compared as they
are. Spans are code points of the text, end exclusive.

Defined cases: null, empty and shorter texts have no spans; repeated rows are
documents of their own and match each other; repeats within one document alone
do not count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.llm.blocks import bucket_bits, count_keys, pack, with_counts
from daymatrix.llm.common import written
from daymatrix.llm.kernels import SpanHash, chunks, windows, words

MIN_WORDS = 50
GRAM = 8
WINDOW = 20
RIGHT = MIN_WORDS - WINDOW + 1


def _reach(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest value of every ``width`` neighbours (doubling)."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[: len(values) - step], values[step:])
        done += step
    return values


def minimisers(grams: np.ndarray) -> np.ndarray:
    """Positions that hold the least hash of some ``WINDOW`` neighbours (all
    of them on a tie)."""
    if len(grams) < WINDOW:
        return np.zeros(0, np.int64)
    least = _reach(grams, WINDOW, np.minimum)
    pad = np.zeros(WINDOW - 1, np.uint64)
    return np.flatnonzero(grams == _reach(np.concatenate([pad, least, pad]), WINDOW, np.maximum))


def _documents(texts: pa.ChunkedArray):
    """Word-window hashes of each text: ``(8-word, RIGHT-word, MIN_WORDS-word
    hashes, word starts and ends in code points)``."""
    for lo, hi, data, off in chunks(texts):
        start, end, first = words(data, off)
        hashed = SpanHash(data)(start, end)
        sets = [windows(hashed, first, k) for k in (GRAM, RIGHT, MIN_WORDS)]
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        for r in range(hi - lo):
            a, b = int(first[r]), int(first[r + 1])
            parts = [h[at[r] : at[r + 1]] for h, _, at in sets]
            yield (*parts, chars[start[a:b]] - chars[off[r]], chars[end[a:b]] - chars[off[r]])


def _anchors(grams: np.ndarray, right: np.ndarray) -> np.ndarray:
    at = minimisers(grams) if len(right) >= WINDOW else np.zeros(0, np.int64)
    return at[at < len(right)]


def _anchor_keys(docs: pa.Table) -> np.ndarray:
    keys = [np.unique(right[_anchors(grams, right)]) for grams, right, *_ in _documents(docs["text"])]
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def _extend(docs: pa.Table, counts: np.ndarray) -> pa.Table:
    """Documents with anchors that another document shares, and the starts of
    the windows that the matches may extend to."""
    rows, starts, at = [], [], 0
    for row, (grams, right, full, _, _) in enumerate(_documents(docs["text"])):
        anchors = _anchors(grams, right)
        keys, where = np.unique(right[anchors], return_inverse=True)
        shared = anchors[counts[at : at + len(keys)][where] > 1]
        at += len(keys)
        if len(shared):
            reach = np.unique(shared[:, None] - np.arange(WINDOW)[None, :])
            reach = reach[(reach >= 0) & (reach < len(full))]
            if len(reach):
                rows.append(row)
                starts.append(reach.astype(np.int32))
    kept = docs.take(pa.array(rows, pa.int64())).select(["row", "doc_id", "text"])
    return kept.append_column("starts", pa.array(starts, pa.list_(pa.int32())))


def _window_keys(docs: pa.Table) -> np.ndarray:
    keys = [np.unique(full[np.asarray(s.values)]) for s, (_, _, full, _, _) in zip(docs["starts"], _documents(docs["text"]))]
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


SPANS = "row long, doc_id long, n_words long, n_repeated_words long, spans array<struct<start:int,end:int>>"


def _spans(docs: pa.Table, counts: np.ndarray) -> pa.Table:
    out, at = [], 0
    for row, doc_id, s, (_, _, full, begin, end) in zip(docs["row"].to_pylist(), docs["doc_id"].to_pylist(), docs["starts"], _documents(docs["text"])):
        starts = np.asarray(s.values)
        keys, where = np.unique(full[starts], return_inverse=True)
        hits = starts[counts[at : at + len(keys)][where] > 1]
        at += len(keys)
        if len(hits):
            gap = np.flatnonzero(np.diff(hits) > MIN_WORDS)
            left, right = hits[np.concatenate([[0], gap + 1])], hits[np.concatenate([gap, [len(hits) - 1]])] + MIN_WORDS
            spans = [{"start": a, "end": b} for a, b in zip(begin[left].tolist(), end[right - 1].tolist())]
            out.append((row, doc_id, len(begin), int((right - left).sum()), spans))
    types = [pa.int64()] * 4 + [pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
    names = ["row", "doc_id", "n_words", "n_repeated_words", "spans"]
    return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(names, types))})


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_repeated_words, spans`` of every document that
    shares a passage of at least ``MIN_WORDS`` words with another one."""
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    blocks = pack(rows, ["row", "doc_id", "text"])
    anchors = count_keys(blocks, _anchor_keys, bucket_bits(docs))
    found = written(
        with_counts(blocks, anchors, _anchor_keys, _extend, "row long, doc_id long, text string, starts array<int>"), "suffix-matches")
    blocks = pack(found, ["row", "doc_id", "text", "starts"])
    shared = count_keys(blocks, _window_keys, bucket_bits(found))
    return with_counts(blocks, shared, _window_keys, _spans, SPANS).drop("row")


def cut_passages(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the given spans."""
    for start, end in sorted(spans, reverse=True):
        text = text[:start] + text[end:]
    return text

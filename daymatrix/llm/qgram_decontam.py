"""Benchmark decontamination by the q-gram lemma.

Text and items are compared in lower case with white-space runs as one space.
An item of ``m`` characters that occurs in a text with at most ``e`` edits
leaves ``m - q + 1 - e * q`` of its q-grams intact, on diagonals that differ by
at most ``e``. So every shared q-gram is counted in the two overlapping
diagonal bands it lies in, regions whose count reaches that bound are kept, and
each is verified by banded alignment. Nothing within the edit budget is missed.

The items are a query set: they are taken in blocks of bounded size, each
block's q-gram index goes to all tasks, and every block is matched against all
rows. Documents are scanned in place, without a shuffle.

Defined cases: null or empty texts match nothing; items of fewer than
``MIN_CHARS`` normalised characters match without edits and between word
boundaries only; those of fewer than ``Q``, a word or two, would be in any text
by chance: they are not searched but listed by ``unsearched_items``; equal items are all reported; an item that occurs several times in a
text gives a row for each region; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.llm.kernels import chunks
from daymatrix.llm.pretokens import SPACES

Q = 8
#: Edits allowed per item character.
EDIT_RATE = 0.1
MIN_CHARS = 32
#: Characters of items in one block, which bounds what is sent to the tasks.
BLOCK_CHARS = 512 << 10
_MUL = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Each code point in lower case (where that is one character), with every
    kind of white space as a blank."""
    table = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000:
            low = chr(c).lower()
            if len(low) == 1:
                table[c] = ord(low)
    table[SPACES] = 32
    return table


def normalise(cp: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised characters, the original position of each, and new row
    offsets."""
    cp = _folded()[cp]
    blank = cp == 32
    keep = np.ones(len(cp), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[off[:-1][off[:-1] < len(cp)]] = True
    at = np.flatnonzero(keep)
    return cp[at], at, np.searchsorted(at, off)


def _qgrams(cp: np.ndarray) -> np.ndarray:
    n = len(cp) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = cp.astype(np.uint64)
    out = wide[:n].copy()
    for j in range(1, Q):
        out *= _MUL
        out += wide[j : j + n]
    return out * _SPREAD


@dataclass
class Index:
    """q-grams of a block of items, sorted, with their places."""

    ids: list[int]
    items: list[np.ndarray]
    budget: np.ndarray
    need: np.ndarray
    short: np.ndarray
    table: np.ndarray
    shift: np.uint64
    grams: np.ndarray
    begin: np.ndarray
    item_of: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Index | None:
        ids, items = [], []
        for item_id, text in rows:
            cp = np.frombuffer((text or "").strip().encode("utf-32-le"), np.uint32)
            cp, _, _ = normalise(cp, np.array([0, len(cp)]))
            if len(cp) >= Q:
                ids.append(item_id)
                items.append(cp)
        if not items:
            return None
        size = np.array([len(x) for x in items])
        short = size < MIN_CHARS
        budget = np.where(short, 0, np.minimum((size * EDIT_RATE).astype(np.int64), (size - Q) // Q))
        every = np.concatenate([_qgrams(x) for x in items])
        item_of = np.repeat(np.arange(len(items)), size - Q + 1)
        place = np.concatenate([np.arange(n) for n in size - Q + 1])
        order = np.argsort(every, kind="stable")
        grams, begin = np.unique(every[order], return_index=True)
        bits = int(min(23, max(16, (16 * len(grams)).bit_length())))
        table = np.zeros(1 << bits, bool)
        shift = np.uint64(64 - bits)
        table[grams >> shift] = True
        return cls(ids, items, budget, size - Q + 1 - budget * Q, short, table, shift, grams, np.append(begin, len(every)), item_of[order], place[order])

    def regions(self, cp: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int]]:
        """``(row, item, first diagonal, end of diagonals)`` of the regions
        that meet the bound, touching ones merged."""
        gram = _qgrams(cp)
        hit = np.flatnonzero(self.table[gram >> self.shift])
        at = np.searchsorted(self.grams, gram[hit])
        good = (at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == gram[hit])
        hit, at = hit[good], at[good]
        row = np.searchsorted(off, hit, "right") - 1
        inside = hit + Q <= off[row + 1]
        hit, at, row = hit[inside], at[inside], row[inside]
        many = self.begin[at + 1] - self.begin[at]
        if not many.sum():
            return []
        src = np.repeat(np.arange(len(hit)), many)
        entry = np.arange(len(src)) - np.repeat(np.cumsum(many) - many, many) + self.begin[at][src]
        item, diagonal = self.item_of[entry], hit[src] - off[row][src] - self.place[entry]
        step = np.maximum(1, self.budget)[item]
        band = diagonal // step
        low = int(band.min()) - 1
        span = int(band.max()) - low + 1
        key = (row[src] * len(self.items) + item) * span + (band - low)
        keys, counts = np.unique(key, return_counts=True)
        # A hit counts in its own band and in the one that begins a step before:
        # the total of band b is what lies in cells b and b + 1.
        after = np.zeros_like(counts)
        joined = keys[1:] == keys[:-1] + 1
        after[:-1][joined] = counts[1:][joined]
        before_only = np.setdiff1d(keys - 1, keys)
        all_keys = np.concatenate([keys, before_only])
        total = np.concatenate([counts + after, counts[np.searchsorted(keys, before_only + 1)]])
        pair, cell = all_keys // span, all_keys % span + low
        which = pair % len(self.items)
        found = np.flatnonzero(total >= self.need[which])
        out: list[list[int]] = []
        for i in found[np.argsort(all_keys[found], kind="stable")].tolist():
            r, it = int(pair[i]) // len(self.items), int(which[i])
            wide = max(1, int(self.budget[it]))
            d = int(cell[i]) * wide
            if out and out[-1][0] == r and out[-1][1] == it and d <= out[-1][3]:
                out[-1][3] = d + 2 * wide
            else:
                out.append([r, it, d, d + 2 * wide])
        return [tuple(x) for x in out]


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, start: int | None = None) -> tuple[int, int]:
    """Least edits of ``item`` against a stretch of ``text`` on the diagonals
    ``low <= text position - item position < high``, and where the stretch
    ends. It may begin on any of them, or only at ``start``."""
    width, far = high - low, len(item) + len(text) + 1
    lane = np.arange(width)
    # Lane k of row j stands for "the first j item characters end before text
    # position j + low + k".
    cost = np.zeros(width, np.int64) if start is None else np.abs(lane + low - start)
    cost = np.where((lane + low < 0) | (lane + low > len(text)), far, cost)
    padded = np.concatenate([np.full(max(0, -low) + 1, 0xFFFFFFFF, np.uint32), text, np.full(len(item) + width + max(0, high), 0xFFFFFFFF, np.uint32)])
    shift = max(0, -low) + 1
    for j, c in enumerate(item.tolist()):
        end = lane + low + j + 1  # text position that row j + 1 ends before
        nxt = cost + (padded[shift + low + j : shift + low + j + width] != c)
        nxt[:-1] = np.minimum(nxt[:-1], cost[1:] + 1)
        nxt[(end < 0) | (end > len(text))] = far
        if low + j < 0:
            nxt[end == 0] = j + 1
        cost = np.minimum.accumulate(nxt - lane) + lane
    cost = np.where((lane + low + len(item) < 0) | (lane + low + len(item) > len(text)), far, cost)
    k = int(np.argmin(cost))
    return int(cost[k]), k + low + len(item)


def locate(item: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """``(edits, start, end)`` of the best stretch of ``text``, or none within
    the budget."""
    edits, end = align(item, text, low - budget, high + budget)
    if edits > budget:
        return None
    back, reach = item[::-1], text[:end][::-1]
    shift = -budget
    again, begin = align(back, reach, shift, budget + 1, start=0)
    return edits, end - begin if again <= budget else max(0, end - len(item)), end


def _stands_alone(text: np.ndarray, start: int, end: int) -> bool:
    """Whether no word of ``text`` goes on over either end of the stretch."""
    inside = lambda at: chr(text[at]).isalnum() and chr(text[at + 1]).isalnum()
    return not (start > 0 and inside(start - 1)) and not (end < len(text) and inside(end - 1))


SCHEMA = "doc_id long, item_id long, start long, end long, edits int"


def _search(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        strings = ["".join(map(chr, x.tolist())) for x in index.items]
        for batch in batches:
            out = []
            for lo, hi, _, _ in chunks(batch["text"]):
                part = batch.slice(lo, hi - lo)
                ids = part["doc_id"].to_pylist()
                texts = pc.fill_null(part["text"], "").to_pylist()
                off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
                cp, at, off = normalise(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), off)
                for row, item, low, high in index.regions(cp, off):
                    text = cp[off[row] : off[row + 1]]
                    size, budget = len(index.items[item]), int(index.budget[item])
                    a, b = max(0, low - budget), min(len(text), high + size + budget)
                    near = text[a:b].astype("<u4").tobytes().decode("utf-32-le")
                    whole = near.find(strings[item])
                    while index.short[item] and whole >= 0 and not _stands_alone(text, a + whole, a + whole + size):
                        whole = near.find(strings[item], whole + 1)
                    if whole < 0 and index.short[item]:
                        continue
                    if whole >= 0:
                        edits, start, end = 0, a + whole, a + whole + size
                    else:
                        found = locate(index.items[item], text, low, high, budget)
                        if found is None:
                            continue
                        edits, start, end = found
                    origin = at[off[row]]
                    first = int(at[off[row] + start] - origin)
                    last = int(at[off[row] + end - 1] - origin) + 1 if end > start else first
                    out.append((ids[row], index.ids[item], first, last, edits))
            types = [pa.int64()] * 4 + [pa.int32()]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(names, types))})

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, start, end, edits``: every benchmark item within its
    edit budget in a document, with its place in the original text (code
    points). ``items`` has ``item_id`` and ``text``."""
    items = items.where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = -(-total // BLOCK_CHARS)
    found = []
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        index = Index.of(sorted((r["item_id"] or 0, r["text"]) for r in part.select("item_id", "text").collect()))
        if index:
            found.append(_search(docs, index))
    if not found:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionByName, found)


def unsearched_items(items: DataFrame) -> DataFrame:
    """The rows of ``items`` that are too short to be searched."""
    folded = F.trim(F.regexp_replace("text", r"\s+", " "))
    return items.where(F.coalesce(F.length(folded), F.lit(0)) < Q)

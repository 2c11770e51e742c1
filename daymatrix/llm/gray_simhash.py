"""SimHash near-duplicates through a Gray-ordered hierarchical index.

A document's fingerprint has a bit where more than half of the 64-bit hashes of
its 3-word shingles (repeats included) have it. Fingerprints link when they
differ in at most two bits. The search works on distinct fingerprints:

* two linked ones agree on at least one of three slices of their bits. Every
  fingerprint goes to three groups, one for each slice and its value there. A
  group of more than ``GROUP`` fingerprints is dealt again by three slices of the
  bits that are left, and so on; after four steps 14 bits are left, so no group
  can exceed 2^14 whatever the data;
* a group is sorted by Gray rank, so that neighbours differ in few bits. Runs of
  ``FAN`` neighbours form nodes that hold the bits all of them share, as a mask
  and a pattern; runs of nodes form upper nodes, up to one root a group. A bit
  that an upper node holds is left out below it;
* all fingerprints of a group go down the tree together, adding up their
  differences from each node's pattern, and leave a node with everything under it
  once they have more than two;
* the links of a run of groups leave the task as a spanning forest, so a dense
  group of thousands of near copies sends a row for each, not for each pair.

Components are then joined over the forest, and documents get theirs through
their fingerprint.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; fewer
than three words are one shingle; a null, empty or blank text has fingerprint 0,
which links like any other; repeated rows are one class; a null id takes part but
names a component only if no other id is in it (then null); other columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.llm.common import written
from daymatrix.llm.graph import components

WORDS = 3
SEED = 42
DISTANCE = 2
SLICES = DISTANCE + 1
#: Fingerprints of a group before it is dealt by further bits.
GROUP = 1024
STEPS = 4
FAN = 8
#: Groups are searched together in runs of about so many fingerprints, and
#: pairs of a fingerprint and a node held at once.
RUN, FRONTIER = 1 << 14, 1 << 20
#: Hashes of a text whose bits are unpacked at once.
HASHES = 1 << 14

_ALL = (1 << 64) - 1


def simhash(text: bytes) -> int:
    """Fingerprint of a text given in UTF-8."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    k = min(WORDS, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), (ends[k - 1 :] - 1).tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), HASHES):
        ones += np.unpackbits(hashes[lo : lo + HASHES].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` per row; the 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(t.as_buffer().to_pybytes()) if t.is_valid else 0 for t in batch["text"]]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "fp": pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def slice_masks(step: int) -> list[int]:
    """Bits that groups share after ``step + 1`` deals, by path; a path's three
    next ones are at 3 * path and on."""
    masks = [0]
    for _ in range(step + 1):
        nxt = []
        for m in masks:
            free = [i for i in range(63, -1, -1) if not m >> i & 1]
            for part in np.array_split(np.array(free), SLICES):
                nxt.append(m | sum(1 << int(i) for i in part))
        masks = nxt
    return masks


def gray_rank(c):
    """Place of a fingerprint in the Gray order, as a long in the same order."""
    for s in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, s))
    return c.bitwiseXOR(F.lit(-(1 << 63)))


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class Tree:
    """Nodes over runs of Gray-sorted fingerprints, the groups' roots on top."""

    def __init__(self, fps: np.ndarray, group: np.ndarray):
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        self.fps, self.levels = fps, []
        # Level 0: each fingerprint is a node that holds all its bits.
        mask, pattern, of = np.full(len(fps), _ALL, np.uint64), fps, np.searchsorted(first, np.arange(len(fps)), "right") - 1
        self.root = of
        while True:
            n_in = np.bincount(of)
            if len(self.levels) and n_in.max() == 1:
                break
            start = np.concatenate([[0], np.cumsum(n_in)[:-1]])
            within = np.arange(len(of)) - start[of]
            lead = np.flatnonzero(within % FAN == 0)
            up = np.searchsorted(lead, np.arange(len(of)), "right") - 1
            same = np.bitwise_and.reduceat(mask & ~(pattern ^ pattern[lead][up]), lead)
            # What the upper node holds is left out of the nodes under it.
            self.levels.append((mask & ~same[up], pattern, lead, np.diff(np.append(lead, len(of)))))
            mask, pattern, of = same, pattern[lead], of[lead]
        self.top = (mask, pattern)

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(query, fingerprint)`` positions of the links within groups, each
        with the smaller position first."""
        q, node = queries, self.root[queries]
        acc = _bits((self.fps[q] ^ self.top[1][node]) & self.top[0][node])
        keep = acc <= DISTANCE
        q, node, acc = q[keep], node[keep], acc[keep]
        for mask, pattern, lead, size in reversed(self.levels):
            n = size[node]
            child = np.repeat(lead[node] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
            q, acc = np.repeat(q, n), np.repeat(acc, n)
            acc = acc + _bits((self.fps[q] ^ pattern[child]) & mask[child])
            keep = acc <= DISTANCE
            q, node, acc = q[keep], child[keep], acc[keep]
        later = node > q
        return q[later], node[later]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest position of each component) after links ``a``-``b``."""
    while len(a):
        x, y = label[a], label[b]
        open_ = x != y
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            nxt = label[label]
            if np.array_equal(nxt, label):
                break
            label = nxt
    return label


def _forest(fps: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the components of each group of a run."""
    tree, label = Tree(fps, group), np.arange(len(fps))
    size = np.bincount(tree.root)[tree.root]
    part = np.cumsum(size) // FRONTIER
    for lo, hi in zip(*(lambda s: (s, np.append(s[1:], len(part))))(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])))):
        label = _merge(label, *tree.near(np.arange(lo, hi)))
    at = np.flatnonzero(label != np.arange(len(fps)))
    return fps[at], fps[label[at]]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def links(fps: np.ndarray, group: np.ndarray) -> pa.RecordBatch:
        alone = np.concatenate([[True], group[1:] != group[:-1]])
        alone &= np.append(alone[1:], True)
        fps, group = fps[~alone], group[~alone]
        a, b = _forest(fps, group) if len(fps) else (fps, fps)
        return pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64), pa.int64()), "b": pa.array(b.view(np.int64), pa.int64())})

    held, last, group = [], None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key, path = batch["key"].to_numpy(), batch["path"].to_numpy()
        new = np.concatenate([[last != (path[0], key[0])], (key[1:] != key[:-1]) | (path[1:] != path[:-1])])
        ids = group + np.cumsum(new)
        last, group = (path[-1], key[-1]), int(ids[-1])
        held.append((batch["fp"].to_numpy().view(np.uint64), ids))
        if sum(len(x) for x, _ in held) >= RUN:
            fps, ids = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(ids, ids[-1]))  # the last group may go on
            if cut:
                yield links(fps[:cut], ids[:cut])
            held = [(fps[cut:], ids[cut:])]
    if held:
        fps, ids = (np.concatenate(x) for x in zip(*held))
        if len(fps):
            yield links(fps, ids)


def near_links(fps: DataFrame) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that join every
    component of fingerprints within two bits."""
    rows = fps.select("fp", F.lit(0).alias("path"))
    found = None
    for step in range(STEPS):
        masks = F.array(*(F.lit(m - (1 << 64) if m >> 63 else m) for m in slice_masks(step)))
        dealt = (
            rows.select("fp", F.explode(F.sequence(F.col("path") * SLICES, F.col("path") * SLICES + (SLICES - 1))).alias("path"))
            .withColumn("key", F.col("fp").bitwiseAND(F.element_at(masks, F.col("path") + 1)))
        )
        hot = None
        if step < STEPS - 1:
            hot = written(dealt.groupBy("path", "key").count().where(F.col("count") > GROUP).select("path", "key"), "simhash-large")
            hot = hot if hot.limit(1).count() else None
        small = dealt.join(hot, ["path", "key"], "left_anti") if hot is not None else dealt
        part = (
            small.withColumn("rank", gray_rank(F.col("fp"))).repartition("path", "key").sortWithinPartitions("path", "key", "rank")
            .select("path", "key", "fp").mapInArrow(_search, "a long, b long")
        )
        found = part if found is None else found.unionByName(part)
        if hot is None:
            break
        rows = dealt.join(hot, ["path", "key"], "left_semi").select("fp", "path")
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs`` (``doc_id``,
    ``text``)."""
    marked = written(fingerprints(docs), "simhash-fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    links = written(near_links(classes.select("fp")).distinct(), "simhash-links")
    joined = components(links).withColumnsRenamed({"node": "fp", "component": "c"})
    named = classes.join(joined, "fp", "left").withColumn("c", F.coalesce("c", "fp"))
    smallest = named.groupBy("c").agg(F.min("first").alias("component_id"))
    of = written(named.select("fp", "c").join(smallest, "c").select("fp", "component_id"), "simhash-components")
    return marked.join(of, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

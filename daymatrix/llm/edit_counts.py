"""Token counts that follow edits.

``build_trees`` cuts each document's pre-tokens into the leaves of a segment tree
and returns the trees as a table: texts of the leaves, characters and tokens of
each pre-token, and the sums of every node. ``apply_edits`` joins a batch of edits
to stored trees and returns the trees after it, to be stored for the next batch;
trees without edits pass as they are. An edit finds its place by the character
sums, encodes again only its text with boundary context, and updates the sums on
the paths to the root.

The context: a pre-token limit depends on the text before it and on one character
after it, or on a special token across it. So the region starts at a limit two
pre-tokens and the longest special token before the edit, and ends at the first
limit after the edit that is one before and after it, seen with as much text behind
it. The rule scans from left to right, so from there on nothing can differ.

Defined cases: a null text counts as empty, with one empty leaf; positions past
the end are clipped to it; edits apply in their order, each to the text that
the earlier ones left; a null replacement deletes; a null position is 0 (start)
or the start (end); rows without edits keep their count; rows that share an id all
take the id's edits; edits of an id without a tree, or of a null id, do nothing.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.llm.bpe_words import default_vocabulary
from daymatrix.llm.common import written
from daymatrix.llm.kernels import chunks
from daymatrix.llm.pretokens import Pretokens, special_tokens, split_special, tokenizer

#: Pre-tokens in a new leaf.
LEAF = 32
#: Pre-tokens before an edit that are split again with it, at least.
CONTEXT = 2
#: Words whose counts a process remembers before it starts afresh.
CACHE_WORDS = 1_000_000


class Counter:
    """Tokens of pre-tokens, each distinct one encoded once per process."""

    def __init__(self, vocabulary: str):
        self.model, self.special, self.known = tokenizer(vocabulary), special_tokens(vocabulary), {}
        #: Characters that a limit may depend on, on either side.
        self.sight = max([4, *map(len, self.special)])

    def sizes(self, distinct: list[str]) -> np.ndarray:
        known = self.known
        new = [w for w in distinct if w not in known]
        if new:
            if len(known) > CACHE_WORDS:
                known = self.known = {}
                new = distinct
            for lo in range(0, len(new), 10_000):
                part = new[lo : lo + 10_000]
                known.update(zip(part, (len(e.ids) for e in self.model.encode_batch_fast(part, add_special_tokens=False))))
        return np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))

    def split(self, texts: list[str]) -> tuple[Pretokens, np.ndarray, np.ndarray]:
        """Pre-tokens, tokens of each, and each text's first pre-token."""
        rows, whole, first = split_special(texts, self.special)
        tokens = Pretokens(rows, whole)
        return tokens, self.sizes(tokens.distinct())[tokens.of], tokens.first[first]


#: What a split gives for one region: starts and tokens of its pre-tokens.
Split = tuple[np.ndarray, np.ndarray]


class TokenTree:
    """Segment tree over a document's leaves. ``text`` has the leaves' texts,
    ``pre`` characters and tokens of their pre-tokens; nodes lie in heap order
    (root 1), with sums of tokens and of characters."""

    def __init__(self, leaves: list[str], pre: list[np.ndarray], counter: Counter, sums: np.ndarray | None = None):
        self.counter = counter
        self.reencoded = 0
        self._build(leaves, pre, sums)

    @classmethod
    def of(cls, text: str, limits: np.ndarray, sizes: np.ndarray, counter: Counter) -> TokenTree:
        return cls(*_leaves(text, _pairs(limits, sizes, len(text))), counter)

    def _build(self, leaves: list[str], pre: list[np.ndarray], sums: np.ndarray | None = None) -> None:
        self.text, self.pre, n = leaves, pre, len(leaves)
        self.base = 1 << max(0, (n - 1).bit_length())
        if sums is not None:
            self.sums = sums
            return
        self.sums = np.zeros((2 * self.base, 2), np.int64)
        self.sums[self.base : self.base + n, 0] = [p[:, 1].sum() for p in pre]
        self.sums[self.base : self.base + n, 1] = [len(x) for x in leaves]
        level = self.base
        while level > 1:
            half = level // 2
            self.sums[half:level] = self.sums[level : 2 * level : 2] + self.sums[level + 1 : 2 * level : 2]
            level = half

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 0])

    @property
    def n_chars(self) -> int:
        return int(self.sums[1, 1])

    def find(self, pos: int) -> tuple[int, int]:
        """Leaf that holds character ``pos`` (the last leaf for the end), and
        the position of the leaf's start."""
        node, before = 1, 0
        if pos >= self.n_chars:
            last = len(self.text) - 1
            return last, self.n_chars - len(self.text[last])
        while node < self.base:
            left = int(self.sums[2 * node, 1])
            if pos < before + left:
                node = 2 * node
            else:
                before, node = before + left, 2 * node + 1
        return node - self.base, before

    def edit(self, start: int | None, end: int | None, replacement: str | None) -> None:
        """Replace characters ``start:end``."""
        edit_together([(self, [(start, end, replacement)])], self.counter)

    def steps(self, edits: Sequence[tuple]) -> Generator[str, Split, None]:
        """Apply ``edits``; yields each region to split and takes its split."""
        for start, end, replacement in edits:
            yield from self._step(start, end, replacement or "")

    def _step(self, start: int | None, end: int | None, replacement: str) -> Generator[str, Split, None]:
        n, sight = self.n_chars, self.counter.sight
        start = min(max(start or 0, 0), n)
        end = min(max(start if end is None else end, start), n)
        shift = len(replacement) - (end - start)
        lo, before = self.find(max(0, start - 1))
        hi, at = self.find(end)
        after = at + len(self.text[hi])
        reach = 4 * sight
        while True:
            while lo > 0 and (start - before < sight or sum(len(p) for p in self.pre[lo : hi + 1]) < CONTEXT + 1):
                lo -= 1
                before -= len(self.text[lo])
            while hi + 1 < len(self.text) and after < end + sight + reach:
                hi += 1
                after += len(self.text[hi])
            pre = np.concatenate(self.pre[lo : hi + 1])
            limit = before + np.concatenate([[0], np.cumsum(pre[:, 0])])
            # The region's first pre-token: CONTEXT before the one that the edit touches.
            first = int(np.searchsorted(limit, max(start - 1, 0), "right")) - 1 - CONTEXT
            first = min(first, int(np.searchsorted(limit, start - sight, "right")) - 1)
            if first < 0 and lo > 0:
                lo -= 1
                before -= len(self.text[lo])
                continue
            first = max(first, 0)
            last = min(int(np.searchsorted(limit, end + sight + reach)), len(limit) - 1)
            stop = int(limit[last])
            old = "".join(self.text[lo : hi + 1])
            head = int(limit[first])
            region = old[head - before : start - before] + replacement + old[end - before : stop - before]
            starts, sizes = yield region
            self.reencoded += len(region)
            # Limits behind the edit that the text after it has too.
            seen = limit[(limit >= end) & (limit <= (stop if stop == n else stop - sight))]
            same = seen[np.isin(seen + shift - head, np.append(starts, len(region)) if stop == n else starts)]
            if len(same):
                break
            reach *= 4
        again = int(same[0])
        k = int(np.searchsorted(starts, again + shift - head))
        new = _pairs(starts[:k], sizes[:k], again + shift - head)
        rest = int(np.searchsorted(limit, again))
        text = old[: start - before] + replacement + old[end - before :]
        self._put(lo, hi, text, np.concatenate([pre[:first], new, pre[rest:]]))

    def _put(self, lo: int, hi: int, text: str, pre: np.ndarray) -> None:
        """New contents of the leaves ``lo..hi``, dealt evenly among them."""
        n = hi - lo + 1
        if len(pre) > 4 * LEAF * n:  # a large insertion: more leaves
            texts, parts = _leaves(text, pre)
            self._build(self.text[:lo] + texts + self.text[hi + 1 :], self.pre[:lo] + parts + self.pre[hi + 1 :])
            return
        cut = [len(pre) * i // n for i in range(n + 1)]
        total = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(pre, axis=0, dtype=np.int64)])
        for i in range(n):
            (a, before), (b, upto) = total[cut[i]], total[cut[i + 1]]
            self.text[lo + i] = text[a:b]
            self.pre[lo + i] = pre[cut[i] : cut[i + 1]]
            self.sums[self.base + lo + i] = upto - before, b - a
        a, b = (self.base + lo) // 2, (self.base + hi) // 2
        while a >= 1:
            for node in range(a, b + 1):
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]
            a, b = a // 2, b // 2


def _pairs(starts: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """Characters and tokens of the pre-tokens that begin at ``starts``."""
    return np.stack([np.diff(np.append(starts, end)), sizes], 1).astype(np.int32)


def _leaves(text: str, pre: np.ndarray) -> tuple[list[str], list[np.ndarray]]:
    """A text cut into leaves, at least one."""
    at = np.concatenate([[0], np.cumsum(pre[:, 0], dtype=np.int64)])
    cut = list(range(0, max(1, len(pre)), LEAF)) + [len(pre)]
    where = at[cut].tolist()
    return [text[a:b] for a, b in zip(where, where[1:])], [pre[a:b] for a, b in zip(cut, cut[1:])]


def edit_together(work: Sequence[tuple[TokenTree, Sequence[tuple]]], counter: Counter) -> None:
    """Apply each tree's edits in their order; the regions of all trees that
    wait for a split are split in one call."""
    waiting = [(steps, next(steps, None)) for steps in (tree.steps(edits) for tree, edits in work)]
    waiting = [(steps, region) for steps, region in waiting if region is not None]
    while waiting:
        tokens, sizes, first = counter.split([region for _, region in waiting])
        following, base = [], 0
        for (steps, region), a, b in zip(waiting, first[:-1].tolist(), first[1:].tolist()):
            try:
                following.append((steps, steps.send((tokens.start[a:b] - base, sizes[a:b]))))
            except StopIteration:
                pass
            base += len(region)
        waiting = following


TREE_SCHEMA = (
    "doc_id long, leaves array<string>, leaf_pretokens array<int>, pre_chars array<int>, pre_tokens array<int>, "
    "node_tokens array<int>, node_chars array<int>"
)
COUNT_SCHEMA = "n_tokens long, n_tokens_after long, n_chars_after long, n_leaves long, n_chars_reencoded long"
TREE_COLUMNS, COUNT_COLUMNS = ([c.split()[0] for c in x.split(", ")] for x in (TREE_SCHEMA, COUNT_SCHEMA))
EDITS = "array<struct<start:long,end:long,replacement:string>>"
#: Characters of the documents that are worked on at a time.
CHUNK = 1 << 20


def _lists(parts: Sequence, kind: pa.DataType) -> pa.Array:
    """A list array of numpy arrays, or of lists of strings."""
    off = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]), pa.int32())
    flat = [x for p in parts for x in p] if kind == pa.string() else np.concatenate([np.zeros(0, np.int64), *parts])
    return pa.ListArray.from_arrays(off, pa.array(flat, kind))


def _tree_columns(trees: Sequence[TokenTree]) -> list[pa.Array]:
    pre = [np.concatenate(t.pre) for t in trees]
    return [
        _lists([t.text for t in trees], pa.string()), _lists([[len(p) for p in t.pre] for t in trees], pa.int32()),
        _lists([p[:, 0] for p in pre], pa.int32()), _lists([p[:, 1] for p in pre], pa.int32()),
        _lists([t.sums[:, 0] for t in trees], pa.int32()), _lists([t.sums[:, 1] for t in trees], pa.int32()),
    ]


def build_trees(docs: DataFrame, vocabulary: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """The segment tree of each row of ``docs`` (``doc_id``, ``text``); the columns
    ``carry`` pass as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or default_vocabulary())
    carry = list(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            for lo, hi, _, _ in chunks(batch["text"], CHUNK):
                part = batch.slice(lo, hi - lo)
                texts = pc.fill_null(part["text"], "").to_pylist()
                tokens, sizes, first = counter.split(texts)
                trees, base = [], 0
                for text, a, b in zip(texts, first[:-1].tolist(), first[1:].tolist()):
                    trees.append(TokenTree.of(text, tokens.start[a:b] - base, sizes[a:b], counter))
                    base += len(text)
                yield pa.RecordBatch.from_arrays([part["doc_id"], *_tree_columns(trees), *(part[c] for c in carry)], names=TREE_COLUMNS + carry)

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(F.col(f"`{c}`") for c in carry))
    schema = ", ".join([TREE_SCHEMA] + [f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in carry])
    return kept.mapInArrow(run, schema)


def edit_trees(trees: DataFrame, vocabulary: str | None = None, keep_trees: bool = True) -> DataFrame:
    """Stored trees after the ``edits`` (array of ``start, end, replacement``) of
    their rows, with counts before and after; without the trees themselves unless
    ``keep_trees``."""
    shared = trees.sparkSession.sparkContext.broadcast(vocabulary or default_vocabulary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            root = np.array([c[1].as_py() for c in batch["node_chars"]], np.int64)
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, lo + int(np.searchsorted(np.cumsum(root[lo:]), CHUNK, "right")))
                part = batch.slice(lo, hi - lo)
                before = [c[1].as_py() for c in part["node_tokens"]]
                stored = _stored(part, counter)
                edits = [[(e["start"], e["end"], e["replacement"]) for e in row or [] if e] for row in part["edits"].to_pylist()]
                edit_together([(t, e) for t, e in zip(stored, edits) if e], counter)
                counts = [before, [t.n_tokens for t in stored], [t.n_chars for t in stored], [len(t.text) for t in stored], [t.reencoded for t in stored]]
                columns = [part["doc_id"], *(_tree_columns(stored) if keep_trees else []), *(pa.array(c, pa.int64()) for c in counts)]
                yield pa.RecordBatch.from_arrays(columns, names=(TREE_COLUMNS if keep_trees else ["doc_id"]) + COUNT_COLUMNS)
                lo = hi

    return trees.select(*TREE_COLUMNS, F.col("edits").cast(EDITS).alias("edits")).mapInArrow(run, f"{TREE_SCHEMA if keep_trees else 'doc_id long'}, {COUNT_SCHEMA}")


def _stored(part: pa.RecordBatch, counter: Counter) -> list[TokenTree]:
    """Trees as stored; nothing is encoded."""
    def rows(name: str) -> list[np.ndarray]:
        column = part[name]
        flat, off = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        return [flat[a:b] for a, b in zip(off, off[1:])]

    out = []
    for leaves, n_pre, chars, tokens, nodes, widths in zip(
        part["leaves"].to_pylist(), rows("leaf_pretokens"), rows("pre_chars"), rows("pre_tokens"), rows("node_tokens"), rows("node_chars")
    ):
        pre = np.split(np.stack([chars, tokens], 1), np.cumsum(n_pre)[:-1])
        out.append(TokenTree(leaves, pre, counter, np.stack([nodes, widths], 1).astype(np.int64)))
    return out


def apply_edits(trees: DataFrame, edits: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Stored ``trees`` after a batch of ``edits`` (rows ``doc_id, seq, start, end,
    replacement``, applied to a document by ``seq``), in the form of ``build_trees``.
    Only trees that have edits go through Python."""
    batch = (
        edits.where("doc_id is not null").groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "start", "end", "replacement"))).alias("edits"))
        .select("doc_id", F.transform("edits", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["replacement"].alias("replacement"))).alias("edits"))
    )
    changed = edit_trees(trees.select(*TREE_COLUMNS).join(batch, "doc_id"), vocabulary).select(*TREE_COLUMNS)
    return changed.unionByName(trees.select(*TREE_COLUMNS).join(batch, "doc_id", "left_anti"))


def tree_counts(trees: DataFrame) -> DataFrame:
    """Tokens and characters of each tree, read from its root."""
    return trees.select("doc_id", F.get("node_tokens", F.lit(1)).cast("long").alias("n_tokens"), F.get("node_chars", F.lit(1)).cast("long").alias("n_chars"))


def count_with_edits(docs: DataFrame, vocabulary: str | None = None, keep_text: bool = True) -> DataFrame:
    """Token counts before and after the ``edits`` (array of ``start, end,
    replacement``) of each row of ``docs`` (``doc_id``, ``text``, ``edits``): the
    trees are stored first, then edited. ``text_after`` is null unless ``keep_text``."""
    trees = written(build_trees(docs, vocabulary, ["edits"]), "token-trees", "zstd")
    out = edit_trees(trees, vocabulary, keep_trees=keep_text)
    after = F.concat_ws("", "leaves") if keep_text else F.lit(None).cast("string")
    return out.select("doc_id", *COUNT_COLUMNS, after.alias("text_after"))


def sample_edits(text: str = "text"):
    """Two edits for each row, derived from its text's length: a replacement
    after a third, and a deletion after two thirds."""
    return sample_edits_of(F.coalesce(F.length(F.col(text)), F.lit(0)))


def sample_edits_of(n):
    """The edits of ``sample_edits`` for a text of ``n`` characters."""
    third = F.floor(n / 3).cast("long")
    return F.array(
        F.struct(third.alias("start"), (third + 7).alias("end"), F.lit(" that's 2024,\n  revised").alias("replacement")),
        F.struct((2 * third).alias("start"), (2 * third + 5).alias("end"), F.lit(None).cast("string").alias("replacement")),
    )

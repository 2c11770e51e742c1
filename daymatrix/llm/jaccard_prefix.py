"""Near duplicates: an exact Jaccard join on word shingles, rare-first.

A document's set holds its distinct 5-word shingles (A-Z lower-cased). Two
documents link when 100 * shared >= 80 * union. The join:

* orders every set by the corpus-wide document count of its shingles, rarest
  first (counts over all documents, see ``blocks``), and keeps the prefix that
  two linked sets must share a shingle in. Shingles that occur in one document
  only cannot be shared and are not even emitted, so a document without
  enough shared shingles leaves the join here;
* collapses equal sets to one representative;
* finds pairs that share a prefix shingle and pass the length filter, the
  positional filter (what can be shared before and after that position, not
  counting shingles that occur in one document only) and a suffix filter
  (shared shingles in each sixteenth of the hash space are at most the smaller
  count there);
* verifies each pair once on the whole texts.

A shingle that many documents hold in their prefix (a large group of copies
with small edits) would pair all with all. So the first rounds compare each
document only with the centre of its shingle's group, the member with the
fewest unshared shingles; a last round compares the members that are still in
different components. Every link between documents of different
components is thus found, which makes the components whole. Links join members
of one component only, so all of them are then counted there: its sets are
compared all with all, in blocks of a bounded number of sets, of which sets of
too different sizes need not meet.

Defined cases: null, empty or blank text has the empty set and links with
nothing; 1 to 4 words form one shingle; repeated rows of one id are one node; a
null id keeps a null component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.llm.blocks import bucket_bits, count_keys, pack, with_counts
from daymatrix.llm.common import BROADCAST_KEYS, written
from daymatrix.llm.graph import components
from daymatrix.llm.kernels import SpanHash, chunks, lower_ascii, mix, windows, words

WORDS = 5
#: A pair links when SIMILAR[1] * shared >= SIMILAR[0] * union.
SIMILAR = (80, 100)
BINS = 16
CENTRE_ROUNDS = 2
#: About this many sets, and shingles, a side of a block of comparisons.
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 20
#: Shared shingles are counted over so many columns at once.
COLUMNS = 4096

DIGEST = "doc_id long, n_shingles long, sig_a long, sig_b long, bins array<int>, prefix array<struct<key:long,pos:int>>, n_rare int, z binary"


def shingle_sets(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    for _, _, data, off in chunks(column):
        data = lower_ascii(data)
        start, end, first = words(data, off)
        grams, _, at = windows(SpanHash(data)(start, end), first, WORDS, whole_if_shorter=True)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            yield np.unique(grams[a:b])


def _keys(docs: pa.Table) -> np.ndarray:
    sets = list(shingle_sets(docs["text"]))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64)


def _digest(docs: pa.Table, counts: np.ndarray) -> pa.Table:
    rows, at = [], 0
    for doc_id, text, keys in zip(docs["doc_id"].to_pylist(), docs["text"], shingle_sets(docs["text"])):
        n = len(keys)
        df = counts[at : at + n]
        at += n
        prefix, z, bins = [], None, []
        rare = int((df < 2).sum())
        length = n - (SIMILAR[0] * n + SIMILAR[1] - 1) // SIMILAR[1] + 1
        if n and rare < length:
            order = np.lexsort((keys, df))[rare:length]
            prefix = [{"key": k, "pos": rare + i} for i, k in enumerate(keys[order].view(np.int64).tolist())]
            bins = np.bincount((keys[df > 1] >> np.uint64(60)).astype(np.int64), minlength=BINS).tolist()
            z = zstandard.compress(text.as_py().encode(), 6)
        with np.errstate(over="ignore"):
            rows.append((doc_id, n, int(keys.sum(dtype=np.uint64).astype(np.int64)) if n else 0,
                         int(mix(keys).sum(dtype=np.uint64).astype(np.int64)) if n else 0, bins, prefix, rare, z))
    names = ["doc_id", "n_shingles", "sig_a", "sig_b", "bins", "prefix", "n_rare", "z"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()),
             pa.list_(pa.struct([("key", pa.int64()), ("pos", pa.int32())])), pa.int32(), pa.binary()]
    return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(zip(names, types))})


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: set size, set signature and the shared part of
    its rare-first prefix; texts only of documents that have one."""
    blocks = pack(docs, ["doc_id", "text"])
    counts = count_keys(blocks, _keys, bucket_bits(docs))
    return with_counts(blocks, counts, _keys, _digest, DIGEST)


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b, shared, total, linked`` for each pair, from the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint64))
        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            shared, total = [], []
            for a, za, zb in zip(batch["a"].to_pylist(), batch["za"], batch["zb"]):
                if last[0] != a:
                    last = (a, next(shingle_sets(pa.array([plain.decompress(za.as_py()).decode()]))))
                other = next(shingle_sets(pa.array([plain.decompress(zb.as_py()).decode()])))
                both = len(np.intersect1d(last[1], other, assume_unique=True))
                shared.append(both)
                total.append(len(last[1]) + len(other) - both)
            linked = [SIMILAR[1] * s >= SIMILAR[0] * t for s, t in zip(shared, total)]
            yield pa.RecordBatch.from_pydict({
                "a": batch["a"], "b": batch["b"], "shared": pa.array(shared, pa.int64()),
                "total": pa.array(total, pa.int64()), "linked": pa.array(linked, pa.bool_())})

    left = texts.select(F.col("doc_id").alias("a"), F.col("z").alias("za"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("z").alias("zb"))
    return written(
        pairs.join(left, "a").join(right, "b").select("a", "b", "za", "zb")
        .mapInArrow(run, "a long, b long, shared long, total long, linked boolean"), "jaccard-pairs")


def _may_link(x: str, y: str):
    """Length, positional and suffix filter for two prefix rows. Only the
    ``n - rare`` shingles that occur in other documents can be shared."""
    nx, ny, px, py, rx, ry = (F.col(f"{s}.{c}") for c in ("n", "pos", "n_rare") for s in (x, y))
    s, t = SIMILAR
    need = F.ceil((nx + ny) * s / F.lit(float(s + t)) - 1e-9)
    length = (F.least(nx, ny) * t) >= (F.greatest(nx, ny) * s)
    position = F.least(px - rx, py - ry) + F.least(nx - px, ny - py) >= need
    suffix = F.expr(f"aggregate(zip_with({x}.bins, {y}.bins, (p, q) -> least(p, q)), 0L, (u, v) -> u + v)") >= need
    return length & position & suffix


def link_classes(cand: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(members, links, reps)``: ``(doc_id, rep)`` for documents with a shared
    prefix, the verified links between representatives of different sets that
    connect the components, and the digests of the representatives."""
    key = ["n_shingles", "sig_a", "sig_b"]
    near = cand.where(F.size("prefix") > 0)
    reps = near.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    members = written(near.select("doc_id", *key).join(reps, key).select("doc_id", "rep").distinct(), "jaccard-members")
    lead = members.select(F.col("rep").alias("doc_id")).distinct()
    kept = written(near.join(lead, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "jaccard-reps")
    texts = kept.select("doc_id", "z")
    rows = written(
        kept.select("doc_id", F.col("n_shingles").alias("n"), "bins", "n_rare", F.explode("prefix").alias("p"))
        .select("doc_id", "n", "n_rare", "bins", F.col("p.key").alias("key"), F.col("p.pos").alias("pos"),
                # Relative number of unshared shingles: the centre of a group of
                # edited copies is the text they were edited from.
                F.struct(((F.col("n_rare") * 1000) / F.col("n")).cast("int").alias("rare"), F.xxhash64("doc_id").alias("h"), "doc_id").alias("rank")),
        "jaccard-rows")

    checked: DataFrame | None = None
    for turn in range(CENTRE_ROUNDS):
        if turn == 0:
            open_rows = rows.withColumn("comp", F.col("doc_id"))
        else:
            comp = components(checked.where("linked"))
            open_rows = _open_rows(rows, comp)
        # The group's centre; in later rounds that of the largest remaining
        # component by rank, compared with members of other components only.
        order = F.col("rank") if turn == 0 else F.struct(F.pmod(F.xxhash64("comp", F.lit(turn)), F.lit(1 << 20)), "rank")
        centre = open_rows.groupBy("key").agg(F.min_by(F.struct("doc_id", "n", "n_rare", "pos", "bins", "comp"), order).alias("c"))
        pairs = (
            open_rows.alias("r").join(centre.alias("k"), "key")
            .select("r.*", "c")
            .where("doc_id <> c.doc_id AND comp <> c.comp")
            .select(F.struct("doc_id", "n", "n_rare", "pos", "bins").alias("x"), F.col("c").alias("y"))
            .where(_may_link("x", "y"))
            .select(F.least("x.doc_id", "y.doc_id").alias("b"), F.greatest("x.doc_id", "y.doc_id").alias("a"))
            .distinct()
        )
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        found = _verify(pairs, texts)
        checked = found if checked is None else checked.unionByName(found)

    links = checked.where("linked")
    open_rows = written(_open_rows(rows, components(links)), "jaccard-open")
    x, y = open_rows.alias("x"), open_rows.alias("y")
    rest = (
        x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.doc_id") > F.col("y.doc_id")) & (F.col("x.comp") != F.col("y.comp")) & _may_link("x", "y"))
        .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()
        .join(checked, ["a", "b"], "left_anti")
    )
    return members, links.unionByName(_verify(rest, texts).where("linked")), kept


def _open_rows(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """Prefix rows whose shingle still joins different components."""
    named = rows.join(comp.withColumnRenamed("node", "doc_id").withColumnRenamed("component", "known"), "doc_id", "left")
    named = named.withColumn("comp", F.coalesce("known", "doc_id")).drop("known")
    mixed = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    return named.join(mixed, "key", "left_semi")


def _linked(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which sets of ``a`` (rows) link with which of ``b`` (columns)."""
    size = np.array([len(x) for x in sets])
    _, key, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.where(held > 1, np.cumsum(held > 1) - 1, -1)[key]
    row = np.repeat(np.arange(len(sets)), size)[column >= 0]
    column = column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(a), len(b)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        at = slice(*np.searchsorted(column, [lo, lo + COLUMNS]))
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[row[at], column[at] - lo] = 1
        shared += has[a] @ has[b].T
    shared = shared.astype(np.int64)
    return SIMILAR[1] * shared >= SIMILAR[0] * (size[a][:, None] + size[b][None, :] - shared)


def _block_links(table: pa.Table) -> pa.Table:
    """``rep, n_links`` of a block: all pairs of its sets, or those between its
    two sides."""
    plain = zstandard.ZstdDecompressor()
    sets = list(shingle_sets(pa.array([plain.decompress(z.as_py()).decode() for z in table["z"]], pa.string())))
    side, weight = (table[c].to_numpy() for c in ("side", "weight"))
    n = np.zeros(len(sets), np.int64)
    if side[0] < 0:
        every = np.arange(len(sets))
        linked = _linked(sets, every, every)
        np.fill_diagonal(linked, False)
        n = linked @ weight
    else:
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if len(a) and len(b):
            linked = _linked(sets, a, b)
            n[a], n[b] = linked @ weight[b], linked.T @ weight[a]
    return pa.table({"rep": table["doc_id"], "n_links": pa.array(n, pa.int64())})


def count_links(reps: DataFrame, members: DataFrame, comp: DataFrame) -> DataFrame:
    """``rep, n_links``: the documents that link with those of each
    representative's set, itself not counted. A small component is one block. In
    a larger one the sets are dealt by size into levels, of which only equal and
    neighbouring ones can link, and each level by a hash into chunks; every two
    chunks that can link are a block."""
    weight = members.groupBy("rep").agg(F.count("doc_id").alias("weight"))
    level = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(SIMILAR[1] / SIMILAR[0])) + 1e-9).cast("int")
    sets = written(
        reps.select("doc_id", "n_shingles", "z").join(comp.withColumnRenamed("node", "doc_id"), "doc_id")
        .join(weight.withColumnRenamed("rep", "doc_id"), "doc_id").withColumn("level", level), "jaccard-sets")
    parts = F.ceil(F.greatest(F.col("m") / BLOCK_SETS, F.col("s") / BLOCK_SHINGLES)).cast("int")
    shape = written(
        sets.groupBy("component", "level").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("s"))
        .groupBy("component").agg(F.sum("m").alias("all"), F.sum("s").alias("shingles"),
                                  F.map_from_entries(F.collect_list(F.struct("level", parts))).alias("chunks"))
        .where(F.col("all") > 1), "jaccard-shape")
    large = shape.where((F.col("all") > BLOCK_SETS) | (F.col("shingles") > BLOCK_SHINGLES)).select("component", "chunks")
    small = shape.join(large, "component", "left_anti").select("component")
    blocks = (
        "concat(transform(sequence(0, chunks[level] - 1), j -> named_struct('lo', level, 'up', 0, 'i', least(mine, j), 'j', greatest(mine, j),"
        " 'side', if(j = mine, -1, if(mine < j, 0, 1)))),"
        " if(chunks[level + 1] is null, array(), transform(sequence(0, chunks[level + 1] - 1), j -> named_struct('lo', level, 'up', 1, 'i', mine, 'j', j, 'side', 0))),"
        " if(chunks[level - 1] is null, array(), transform(sequence(0, chunks[level - 1] - 1), j -> named_struct('lo', level - 1, 'up', 1, 'i', j, 'j', mine, 'side', 1))))")
    few = large.count() <= BROADCAST_KEYS
    dealt = (
        sets.join(F.broadcast(large) if few else large, "component")
        .withColumn("mine", F.expr("cast(pmod(xxhash64(doc_id), chunks[level]) as int)"))
        .select("component", "doc_id", "z", "weight", F.explode(F.expr(blocks)).alias("block"))
        .select("component", "doc_id", "z", "weight", "block.*")
    )
    whole = sets.join(small, "component").select("component", "doc_id", "z", "weight", *(F.lit(0).alias(c) for c in ("lo", "up", "i", "j")), F.lit(-1).alias("side"))
    found = whole.unionByName(dealt).groupBy("component", "lo", "up", "i", "j").applyInArrow(_block_links, "rep long, n_links long")
    return weight.join(found.groupBy("rep").agg(F.sum("n_links").alias("n")), "rep", "left").select(
        "rep", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Digests, members, digests of representatives, and components."""
    cand = written(digests(docs.select("doc_id", "text")), "jaccard-digests")
    members, links, reps = link_classes(cand)
    links = written(links.select("a", "b"), "jaccard-links")
    return cand, members, reps, components(links.unionByName(members.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))


def near_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs`` (``doc_id``,
    ``text``)."""
    cand, _, _, comp = _classes(docs)
    return (
        cand.select("doc_id", "n_shingles").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` per row of ``docs``
    (``doc_id``, ``text``): ``n_links`` counts the other documents that the
    document links with, those of an equal set among them."""
    cand, members, reps, comp = _classes(docs)
    degree = written(count_links(reps, members, comp), "jaccard-degrees")
    per_doc = comp.join(members.withColumnRenamed("doc_id", "node"), "node").join(degree, "rep", "left")
    return (
        cand.select("doc_id", "n_shingles")
        .join(per_doc.select(F.col("node").alias("doc_id"), "component", "n_links"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )

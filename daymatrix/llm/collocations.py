"""Phrase collocations by top-order marginalisation.

Texts (A-Z lower-cased) are cut at ``. , ; : ! ?`` and line breaks into pieces
and those at blanks and tabs into words. Every word opens one window: the word
and the four that lead it in its piece, padded where the piece ends. Only these
longest windows are counted; the count of a shorter phrase is the sum of the
windows that begin with it, so one ROLLUP over the five window columns gives the
counts of all phrases of one to five words, and its outermost level the words of
a language.

A phrase is a candidate from ``min_count`` occurrences on, and then every two and
every three neighbouring words of it have at least as many. Windows are therefore
cut short at the first two or three words that have fewer in the whole corpus, and
words that have fewer open no window (they add to the language's total only).
These counts come from ``blocks``, by 48-bit keys: equal keys of different words
can only raise a count and leave a window longer than need be, so no phrase's
count changes.

For every cut of a candidate after its first k words, with a the candidate's
count, l and r those of its two parts and n the words of the language, the score
is floor(1000 * a * n / (l * r)), in exact decimals; the lowest cut counts, ties
to the smallest k. A candidate is left out if a longer phrase that holds it is as
frequent. If any is, one that is a single word longer is too (counts only fall
with length), so the two one-word-shorter parts of every candidate are all that
need be compared.

Defined cases: a null or empty text has no words; a null ``lang`` counts as
``und``; repeated rows count each; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymatrix.llm.blocks import bucket_bits, bytes_table, count_keys, pack, release, table_bytes, with_counts
from daymatrix.llm.common import written
from daymatrix.llm.kernels import SpanHash, chunks, lower_ascii, mix

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
UNKNOWN = "und"
PAD = ""

#: Byte classes: 0 part of a word, 1 between words, 2 between pieces.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2

#: An odd multiplier for hashes of hashes.
ODD = np.uint64(0x9E3779B97F4A7C15)

COLUMNS = [f"w{i + 1}" for i in range(LONGEST)]
WINDOWS = "lang string, " + ", ".join(f"{c} string" for c in COLUMNS) + ", n long"


class Words:
    """The words of a block: their texts, the language of each, and whether the
    next word follows in the same piece. Found in chunks of a few documents."""

    def __init__(self, docs: pa.Table):
        langs = pc.fill_null(docs["lang"], UNKNOWN).combine_chunks().dictionary_encode()
        if isinstance(langs, pa.ChunkedArray):
            langs = langs.combine_chunks()
        self.langs = langs.dictionary.to_pylist()
        lang = langs.indices.to_numpy().astype(np.int32)
        salt = np.array([hash_name(x) for x in self.langs] or [0], np.uint64)
        parts = [self._chunk(data, off, lang[lo:hi], salt) for lo, hi, data, off in chunks(docs["text"])]
        empty = (np.zeros(0, bool), np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8))
        self.follows, self.lang, self.hash, self._sizes, self._bytes = (np.concatenate(x) for x in zip(empty, *parts))

    @staticmethod
    def _chunk(data: np.ndarray, off: np.ndarray, lang: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, ...]:
        data = lower_ascii(data)
        kind, n = _CLASS[data], len(data)
        cut = np.zeros(n + 1, bool)
        cut[off] = True
        solid = kind == 0
        start, end = solid.copy(), solid.copy()
        start[1:] &= ~solid[:-1] | cut[1:n]
        end[:-1] &= ~solid[1:] | cut[1:n]
        first, last = np.flatnonzero(start), np.flatnonzero(end) + 1
        row = np.searchsorted(off, first, "right") - 1
        piece = np.searchsorted(np.flatnonzero(kind == 2), first)
        follows = np.zeros(len(first), bool)
        follows[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
        hashes = mix(SpanHash(data)(first, last) ^ salt[lang[row]])
        return follows, lang[row], hashes, last - first, data[solid]

    def chains(self) -> tuple[np.ndarray, np.ndarray]:
        """Words that one more, and two more words of the piece follow."""
        two = np.flatnonzero(self.follows)
        return two, two[:-1][np.diff(two) == 1] if len(two) else two

    def keys(self) -> np.ndarray:
        """A key for every word, then for every two and every three in a row."""
        two, three = self.chains()
        pairs = mix(self.hash[two] * ODD + self.hash[two + 1])
        triples = mix((self.hash[three] * ODD + self.hash[three + 1]) * ODD + self.hash[three + 2])
        return np.concatenate([self.hash, pairs, triples])

    def texts(self) -> pa.DictionaryArray:
        ends = np.concatenate([[0], np.cumsum(self._sizes)]).astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(self._bytes)]).dictionary_encode()


def hash_name(name: str) -> int:
    raw = np.frombuffer(name.encode(), np.uint8)
    return int(SpanHash(raw)(np.array([0]), np.array([len(raw)]))[0])


def _keys(docs: pa.Table) -> np.ndarray:
    return Words(docs).keys()


def _windows(min_count: int, bits: int):
    def run(docs: pa.Table, counts: np.ndarray) -> pa.Table:
        words = Words(docs)
        n = len(words.hash)
        texts = words.texts()
        ids, names = texts.indices.to_numpy(zero_copy_only=False), texts.dictionary.cast(pa.string())
        common = counts[:n] >= min_count
        two, three = words.chains()
        pair, triple = np.zeros(n + LONGEST, bool), np.zeros(n + LONGEST, bool)
        pair[two] = counts[n : n + len(two)] >= min_count
        triple[three] = counts[n + len(two) :] >= min_count
        # A window takes its k-th word while the last two or three words up to it are common.
        more, columns, key = common.copy(), [ids], words.hash.copy()
        for k in range(1, LONGEST):
            more &= pair[:n] if k == 1 else triple[k - 2 : k - 2 + n]
            columns.append(np.where(more, np.append(ids[k:], np.zeros(min(k, n), ids.dtype)), -1))
            at = np.flatnonzero(more)
            key[at] = mix(key[at] * ODD + words.hash[at + k])
        at = np.flatnonzero(common)
        table = pa.table({"lang": pa.array(words.lang[at], pa.int32()), **{c: pa.array(v[at], pa.int32()) for c, v in zip(COLUMNS, columns)}, "key": key[at]})
        table = table.group_by(["lang", *COLUMNS]).aggregate([([], "count_all"), ("key", "min")])
        rest = np.bincount(words.lang[~common], minlength=len(words.langs))
        tail = np.flatnonzero(rest)
        langs = pa.array(words.langs, pa.string())
        word = lambda c: pc.fill_null(names.take(pc.if_else(pc.less(c, 0), None, c)), PAD)
        out = pa.table({
            "lang": pa.concat_arrays([langs.take(table["lang"].combine_chunks()), langs.take(pa.array(tail))]),
            **{c: pa.concat_arrays([word(table[c].combine_chunks()), pa.array([PAD] * len(tail), pa.string())]) for c in COLUMNS},
            "n": pa.concat_arrays([table["count_all"].combine_chunks().cast(pa.int64()), pa.array(rest[tail], pa.int64())]),
        })
        keys = np.concatenate([table["key_min"].to_numpy(), np.array([hash_name(words.langs[i]) for i in tail], np.uint64)])
        bucket = (keys >> np.uint64(64 - bits)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        out, bucket = out.take(order), bucket[order]
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(bucket))
        return pa.table({"bucket": pa.array(bucket[first], pa.int32()),
                         "payload": pa.array([table_bytes(out.slice(a, b - a)) for a, b in zip(first, ends)], pa.binary())})

    return run


def _add(table: pa.Table) -> pa.Table:
    parts = pa.concat_tables([bytes_table(x.as_py()) for x in table["payload"]])
    names = ["lang", *COLUMNS]
    try:
        return parts.group_by(names).aggregate([("n", "sum")]).rename_columns([*names, "n"])
    finally:
        release()


def windows(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, w1..w5, n``: the distinct longest windows, padded with empty
    words, and their counts. Words too rare for any candidate stand together as
    an all-padded window of their language. Blocks send their windows in packed
    buckets by hash, which add up what all blocks hold."""
    blocks, bits = pack(docs, ["lang", "text"]), bucket_bits(docs)
    counts = count_keys(blocks, _keys, bits)
    packed = with_counts(blocks, counts, _keys, _windows(min_count, bits), "bucket int, payload binary")
    return packed.groupBy("bucket").applyInArrow(_add, WINDOWS)


def phrases(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, words, f``: every phrase of up to five words that occurs
    ``min_count`` times or more; an empty phrase has the language's words."""
    longest = windows(docs.select(F.col("lang").cast("string").alias("lang"), "text"), min_count)
    level = F.grouping_id()
    known = longest.rollup("lang", *COLUMNS).agg(F.sum("n").alias("f"), level.alias("g"))
    # The grouping id has a bit for every column that is summed over.
    size = F.lit(LONGEST) - F.length(F.regexp_replace(F.bin("g"), "0", ""))
    return (
        known.where(F.col("g") < (1 << LONGEST))
        .select("lang", "f", size.cast("int").alias("k"), F.array(*COLUMNS).alias("all"))
        .select("lang", F.expr("slice(all, 1, k)").alias("words"), "f")
        .where(f"size(words) = 0 OR (f >= {int(min_count)} AND NOT array_contains(words, '{PAD}'))")
    )


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first
    ``top`` phrases."""
    known = written(phrases(docs, min_count), "phrases")
    named = known.select("lang", F.concat_ws(" ", "words").alias("phrase"), F.size("words").alias("k"), "words", "f")
    total = named.where("k = 0").select("lang", F.col("f").alias("n"))
    parts = named.where("k > 0")
    whole = named.where("k > 1")
    cuts = whole.select(
        "lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, k - 1)")).alias("cut"), "words", "k"
    ).select("lang", "phrase", "a", "cut", F.expr("concat_ws(' ', slice(words, 1, cut))").alias("left"), F.expr("concat_ws(' ', slice(words, cut + 1, k - cut))").alias("right"))
    scored = (
        cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .join(total, "lang")
        .withColumn("score", F.expr(
            "(CAST(a * 1000 AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0))) DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"))
    )
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    inner = (
        named.where("k > 2")
        .select("lang", F.col("f").alias("a"), F.explode(F.expr("array(concat_ws(' ', slice(words, 1, k - 1)), concat_ws(' ', slice(words, 2, k - 1)))")).alias("phrase"))
        .distinct()
    )
    order = Window.partitionBy("lang").orderBy(F.desc("b.score"), F.desc("a"), "phrase")
    return (
        best.join(inner, ["lang", "phrase", "a"], "left_anti")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "b.l", "b.r", "n", F.col("b.score").cast("long").alias("score"))
    )


_WORDS_SQL = ", ".join(f"lead(w, {i}) OVER s AS w{i + 1}" for i in range(1, LONGEST))


def oracle_sql(min_count: int = MIN_COUNT, top: int = TOP) -> str:
    """The same in DuckDB: every phrase length counted on its own."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, list_value({', '.join(f'w{i + 1}' for i in range(k))}) AS words, count(*) AS f FROM leads"
        f" WHERE w{k} IS NOT NULL GROUP BY ALL HAVING count(*) >= {min_count}" for k in range(1, LONGEST + 1))
    return f"""
WITH pieces AS (
  SELECT doc, lang, generate_subscripts(p, 1) AS piece, unnest(p) AS piece_text FROM (
    SELECT row_number() OVER () AS doc, coalesce(lang, '{UNKNOWN}') AS lang,
           string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS p
    FROM documents WHERE text IS NOT NULL)),
words AS (SELECT doc, lang, piece, generate_subscripts(x, 1) AS pos, unnest(x) AS w FROM (
  SELECT doc, lang, piece, regexp_extract_all(piece_text, '[^\\x20\\x09]+') AS x FROM pieces)),
leads AS (SELECT lang, w AS w1, {_WORDS_SQL} FROM words WINDOW s AS (PARTITION BY doc, piece ORDER BY pos)),
total AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
phrases AS ({grams}),
cuts AS (
  SELECT p.lang, p.words, p.f AS a, c.cut, x.f AS l, y.f AS r, t.n,
         CAST((1000::HUGEINT * p.f * t.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM phrases p, (SELECT unnest(range(1, {LONGEST})) AS cut) c, phrases x, phrases y, total t
  WHERE p.k > c.cut AND x.lang = p.lang AND x.words = p.words[1:c.cut] AND y.lang = p.lang AND y.words = p.words[c.cut + 1:p.k] AND t.lang = p.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1),
kept AS (SELECT b.* FROM best b WHERE NOT EXISTS (
  SELECT 1 FROM phrases q, (SELECT unnest(range(0, {LONGEST})) AS o) s
  WHERE q.lang = b.lang AND q.k > len(b.words) AND s.o + len(b.words) <= q.k AND q.words[s.o + 1:s.o + len(b.words)] = b.words AND q.f >= b.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank,
       array_to_string(words, ' ') AS phrase, a, l, r, n, score
FROM kept QUALIFY rank <= {top}"""

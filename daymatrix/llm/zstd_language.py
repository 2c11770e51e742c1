"""Language identification by compression.

For every language a zstandard dictionary of raw text (no training, just
content) is cut from labelled documents. A text is compressed with each of
them, block by block, and the language whose dictionary gives the fewest bytes
wins. ``score`` is the winner's relative lead over the runner-up, scaled to
0..1; ``accepted`` is false where that lead is below ``min_margin``.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
ties go to the language with more labelled rows, then the one that sorts first; without any labelled row everything
is ``und``; a single learned language always wins with score 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Labelled documents sampled for each language, and bytes of dictionary.
SAMPLE_DOCS = 400
DICT_BYTES = 96 << 10
#: Text is compressed in blocks, so that in a long text each block still
#: draws on the dictionary rather than on the text before it.
BLOCK_CHARS = 8 << 10
LEVEL = 3
#: Stretches that a text longer than its share of a dictionary gives.
STRETCHES = 4
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """The text as it is compressed: lower case, everything between runs of
    letters as one space, so that layout, case and numbers tell nothing."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


def learn_dictionaries(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Raw-content dictionaries by language from ``doc_id, lang, text`` rows.

    The sample is bounded: about ``sample_docs`` documents for each language,
    taken by a hash of the id. Each gives its share of the dictionary's bytes: a
    language with few documents takes more of each, up to whole texts. Counting
    the rows per language comes first, so that a frequent language is thinned
    out before any sort.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, 2 * sample_docs / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    piece = F.lit(0)
    for lang, n in sizes.items():
        piece = F.when(F.col("lang") == lang, max(256, 2 * dict_bytes // min(n, sample_docs))).otherwise(piece)
    sample = (
        rows.where(draw < share * (1 << 30))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(draw, "doc_id")))
        .where(F.col("rank") <= sample_docs)
        # Dictionary content only; classification reads whole texts. A text longer
        # than its share gives stretches from its start to its end: stock lines
        # at either end must not speak for one language.
        .withColumn("size", piece).withColumn("long", F.length("text"))
        .select("lang", "rank", F.when(F.col("long") <= F.col("size"), F.col("text")).otherwise(F.concat_ws(" ", *(
            F.expr(f"substring(text, int(1 + (long - size div {STRETCHES}) * {i} div {STRETCHES - 1}), int(size div {STRETCHES}))")
            for i in range(STRETCHES)))).alias("piece"))
        .collect()
    )
    out: dict[str, bytes] = {}
    for lang in sorted(sizes, key=lambda x: (-sizes[x], x)):  # the order breaks ties
        pieces = [r["piece"] for r in sorted(sample, key=lambda r: r["rank"]) if r["lang"] == lang]
        out[lang] = " ".join(map(letters, pieces)).encode()[-dict_bytes:]
    return out


def classify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.01) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` for every row; only
    the text decides."""
    names = list(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = []
        for name in names:
            content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            models.append(zstandard.ZstdCompressor(dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False))
        for batch in batches:
            best, lead = [], []
            for value in batch.column(2):
                text = letters(value.as_py() or "")
                if not names or not any(map(str.isalpha, text)):
                    best.append("und")
                    lead.append(0.0)
                    continue
                blocks = [text[i : i + BLOCK_CHARS].encode() for i in range(0, len(text), BLOCK_CHARS)]
                sizes = sorted((sum(len(m.compress(b)) for b in blocks), i) for i, m in enumerate(models))
                best.append(names[sizes[0][1]])
                lead.append(1.0 if len(sizes) == 1 else (sizes[1][0] - sizes[0][0]) / sizes[1][0])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "held_out": batch.column(1),
                "lang_pred": pa.array(best, pa.string()),
                "score": pa.array([min(1.0, max(0.0, x) * (1 if len(names) == 1 else 5)) for x in lead], pa.float64()),
                "accepted": pa.array([x >= min_margin for x in lead], pa.bool_()),
            })

    held = F.coalesce(F.col("held_out"), F.lit(False)).alias("held_out")
    return docs.select("doc_id", held, "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")


def held_out(doc_id: str = "doc_id"):
    """The fold rule: crc32 of the id as text, modulo 5, is 0."""
    return (F.crc32(F.col(doc_id).cast("string")) % 5) == 0


def identify_languages(docs: DataFrame) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold and classify all
    rows. Expects ``doc_id``, ``text`` and ``lang``."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out())
    return classify(rows, learn_dictionaries(rows.where(~F.col("held_out"))))

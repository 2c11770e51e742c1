"""Quality by ordinal regression on graded ratings.

A cumulative-link model: one weight vector over hashed text features and ordered
thresholds, ``P(grade > k) = sigmoid(w.x - t_k)``. A document's score is its
expected grade; the tail probability ``P(grade >= select_grade)`` decides on
selection.

Features are the distinct words of the whole text (A-Z lower-cased, without
punctuation at the end) and the last two and three bytes as they stand, hashed;
those that tell grades apart over the whole sample are learned. Weights are
fitted by AdaGrad steps in a few parallel parts whose results are averaged, over
a bounded sample of rated rows.

Defined cases: a text without words (null, empty, blank) has score 0 and is not
kept; rows rated null are not learned from; without rated rows every grade is
equally likely and nothing is kept; ties of ratings for an id all count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymatrix.llm.common import written
from daymatrix.llm.kernels import SpanHash, chunks, lower_ascii, words

BITS = 18
#: At most about this many rated documents are learned from.
SAMPLE_DOCS = 20_000
#: Punctuation marks at a word's end that its feature leaves out.
MARKS = 4
_MARK = np.zeros(256, bool)
_MARK[np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~", np.uint8)] = True
PARTS, ROUNDS, EPOCHS = 6, 3, 2
RATE, DECAY = 0.1, 1e-5
#: Least documents of the sample, and standard deviations, for a feature to be
#: learned.
MIN_DOCS, MIN_Z = 8, 4.0


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    @property
    def grades(self) -> int:
        return len(self.thresholds) + 1


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """Distinct feature numbers of each text."""
    mask = np.uint64((1 << BITS) - 1)
    for _, _, data, off in chunks(texts):
        data = lower_ascii(data)
        start, end, first = words(data, off)
        hashes = SpanHash(data)
        size = end - start
        bare_end = end.copy()
        for _ in range(MARKS):
            bare_end -= (bare_end > start) & _MARK[data[np.maximum(bare_end, 1) - 1]]
        kinds = [hashes(start, bare_end), hashes(end - np.minimum(size, 2), end) + np.uint64(1), hashes(end - np.minimum(size, 3), end) + np.uint64(2)]
        ids = np.stack(kinds) & mask
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield np.unique(ids[:, a:b]).astype(np.int64)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def _document_counts(grades: int):
    """Per task, of each feature: its documents, and those graded above each
    threshold. The feature after the last one stands for all documents."""
    every = 1 << BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((grades, every + 1), np.int64)
        for batch in batches:
            for y, x in zip(batch["grade"].to_pylist(), batch["x"]):
                n[: y + 1, np.asarray(x.values)] += 1
                n[: y + 1, every] += 1
        held = np.flatnonzero(n[0])
        yield pa.RecordBatch.from_pydict({"x": pa.array(held, pa.int32())} | {f"n{k}": pa.array(n[k][held], pa.int64()) for k in range(grades)})

    return count


def _telling(sample: DataFrame, grades: int) -> np.ndarray:
    """Features whose documents' grades differ from the rest by more than
    chance: held by ``MIN_DOCS`` documents of the sample, and at some threshold
    ``MIN_Z`` standard deviations off. The others would only add noise."""
    names = [f"n{k}" for k in range(grades)]
    # At most 2^BITS + 1 rows of a few numbers.
    sums = (
        sample.mapInArrow(_document_counts(grades), ", ".join(["x int", *(f"{c} long" for c in names)]))
        .groupBy("x").agg(*(F.sum(c).alias(c) for c in names)).toArrow()
    )
    n = np.zeros((grades, (1 << BITS) + 1), np.int64)
    n[:, sums["x"].to_numpy()] = [sums[c].to_numpy() for c in names]
    df, docs = n[0, :-1], n[0, -1]
    keep = np.zeros(1 << BITS, bool)
    for above in n[1:]:
        p = above[-1] / docs
        spread = np.sqrt(np.maximum(df * p * (1 - p) * (1 - df / docs), 1e-9))
        keep |= np.abs(above[:-1] - df * p) > MIN_Z * spread
    return keep & (df >= MIN_DOCS)


def _steps(rows: list[tuple[int, np.ndarray]], model: Model, keep: np.ndarray, seed: int) -> tuple[Model, np.ndarray]:
    """AdaGrad over the rows' features in ``keep``, ``EPOCHS`` times in random
    order; also the squared slopes that each weight was learned from."""
    w, t = model.weights.astype(np.float64), model.thresholds.copy()
    g_w, g_t = np.full(len(w), 1.0), np.full(len(t), 1.0)
    order = np.random.default_rng(seed)
    top = len(t)
    rows = [(y, x[keep[x]]) for y, x in rows]
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            y, x = rows[i]
            f = w[x].sum()
            above = _sigmoid(t[y] - f) if y < top else 1.0
            below = _sigmoid(t[y - 1] - f) if y > 0 else 0.0
            p = max(above - below, 1e-9)
            d = above + below - 1.0  # slope of the log likelihood in f
            grad = d - DECAY * w[x]
            g_w[x] += d * d
            w[x] += RATE * grad / np.sqrt(g_w[x])
            if y < top:
                d_t = above * (1 - above) / p
                g_t[y] += d_t * d_t
                t[y] += RATE * d_t / np.sqrt(g_t[y])
            if y > 0:
                d_t = -below * (1 - below) / p
                g_t[y - 1] += d_t * d_t
                t[y - 1] += RATE * d_t / np.sqrt(g_t[y - 1])
            t = np.maximum.accumulate(t + np.arange(top) * 1e-6)
    return Model(w, t), g_w - 1.0


def _learner(shared, turn: int):
    def learn(table: pa.Table) -> pa.Table:
        rows = list(zip(table["grade"].to_pylist(), (np.asarray(x.values) for x in table["x"])))
        out, seen = _steps(rows, *shared.value, 100 * turn + table["part"][0].as_py())
        return pa.table({"n": pa.array([len(rows)], pa.int64()), "w": pa.array([out.weights.astype(np.float32).tobytes()], pa.binary()),
                         "seen": pa.array([seen.astype(np.float32).tobytes()], pa.binary()),
                         "t": pa.array([out.thresholds.tobytes()], pa.binary())})

    return learn


def fit(rated: DataFrame, grades: int, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from ``doc_id, text, grade`` rows, thinned by a hash of the id to
    about ``sample_docs``."""
    rated = rated.where(F.col("grade").isNotNull())
    n = rated.count()
    model = Model(np.zeros(1 << BITS, np.float32), np.linspace(-1, 1, grades - 1) if grades > 2 else np.zeros(grades - 1))
    if n == 0:
        return model
    draw = F.pmod(F.xxhash64("doc_id", F.lit("rated")), F.lit(1 << 30))

    def prepare(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "part": batch["part"], "grade": batch["grade"],
                "x": pa.array([x.astype(np.int32) for x in features(batch["text"])], pa.list_(pa.int32()))})

    sample = written(
        rated.where(draw < min(1.0, sample_docs / n) * (1 << 30))
        .select(F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int").alias("part"), F.col("grade").cast("int"), "text")
        .mapInArrow(prepare, "part int, grade int, x array<int>"), "ordinal-sample")
    spark = rated.sparkSession
    if sample.isEmpty():
        return model
    keep = _telling(sample, grades)
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((model, keep))

        # At most PARTS rows of two vectors each.
        parts = sample.groupBy("part").applyInArrow(_learner(shared, turn), "n long, w binary, seen binary, t binary").collect()
        share = np.array([p["n"] for p in parts], float)
        share /= share.sum()
        # A part has a say on a weight by what it learned it from: parts that
        # hold a rare feature seldom or never would pull it back.
        seen = np.stack([np.frombuffer(p["seen"], np.float32) for p in parts]).astype(np.float64)
        moved = np.stack([np.frombuffer(p["w"], np.float32) for p in parts]) - model.weights
        model = Model((model.weights + (moved * seen).sum(axis=0) / np.maximum(seen.sum(axis=0), 1e-12)).astype(np.float32),
                      sum(s * np.frombuffer(p["t"], np.float64) for s, p in zip(share, parts)))
        shared.unpersist()
    return model


def score(docs: DataFrame, model: Model, select_grade: int, min_tail: float = 0.4) -> DataFrame:
    """``doc_id, score, expected_grade, p_tail, kept`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fitted = bool(np.any(model.weights))

    def run(batches):
        model = shared.value
        for batch in batches:
            xs = list(features(batch["text"]))
            f = np.array([model.weights[x].sum(dtype=np.float64) for x in xs])
            tail = _sigmoid(f[:, None] - model.thresholds[None, :]) if len(xs) else np.zeros((0, len(model.thresholds)))
            has = np.array([len(x) > 0 for x in xs], bool)
            p = tail[:, select_grade - 1]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "score": pa.array(f, pa.float64()),
                "expected_grade": pa.array(np.where(has, tail.sum(axis=1), 0.0), pa.float64()),
                "p_tail": pa.array(np.where(has, p, 0.0), pa.float64()),
                "kept": pa.array(has & (p >= min_tail) & fitted, pa.bool_())})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, expected_grade double, p_tail double, kept boolean")


def grade_of_labels() -> Column:
    """Grades from the two labels: 0 poor, 1 good but toxic, 2 good."""
    return F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))


def rate_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the rated documents and score all of them; grade 2 is
    selected."""
    rated = docs.select("doc_id", "text").join(labels.select("doc_id", grade_of_labels().alias("grade")), "doc_id")
    return score(docs, fit(rated, 3), select_grade=2)

"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document is the mean of its words' hashed shapes, the mean of its distinct
words' hashed spellings (a word that occurs n times counts 1 + ln n), and one
hashed feature for every tenth of its words that repeat the word before them;
so a grade's logit is a mean of shape weights, a mean of word weights and a sum
of repeat weights. All grades share the weights; ordered thresholds
separate them: P(grade <= k) = sigmoid(threshold_k - score). The result is an
expected grade and the tail probability of being good enough.

The model is fitted in NumPy on a bounded sample of rated rows (``SAMPLE``,
lowest hashes of their ids; a documented parameter); every document is scored,
whole texts always.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import ship, worker_state

BUCKETS = 1 << 18
#: Rated rows that the fit uses at most.
SAMPLE = 6000
STEPS = 150
RATE = 0.3
PENALTY = 1e-2
SEED = 11
#: Words remembered by a Python worker.
CACHE_WORDS = 150_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Letters become a, capitals A, digits 0, other UTF-8 bytes u; marks stay.
_SHAPE = bytes(ord("0") if 48 <= b < 58 else ord("A") if 65 <= b < 91 else ord("a") if 97 <= b < 123
               else ord("u") if b > 127 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)


def _bucket(name: bytes) -> int:
    return xxhash.xxh64_intdigest(name, SEED) % BUCKETS


def features(word: bytes) -> tuple[int, int]:
    """Buckets of a word and of its shape (runs collapsed)."""
    return _bucket(b"w:" + word.translate(_LOWER)), _bucket(b"s:" + _RUN.sub(rb"\1", word.translate(_SHAPE)))


def repeat_buckets(words: list[bytes]) -> list[int]:
    """One bucket for every tenth of the words that repeat the word before."""
    again = sum(map(bytes.__eq__, words, words[1:]))
    return [_bucket(b"r:%d" % k) for k in range(1, 10 * again // len(words) + 1)]


def word_shares(words: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, their damped shares and their shares."""
    kinds = Counter(words)
    n = np.fromiter(kinds.values(), np.float64, len(kinds))
    damped = 1 + np.log(n)
    return list(kinds), damped / damped.sum(), n / len(words)


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their values."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    kinds, damped, shares = word_shares(words)
    more = repeat_buckets(words)
    pairs = np.array([features(w) for w in kinds])
    at = np.concatenate((pairs[:, 0], pairs[:, 1], np.array(more, np.int64)))
    places, inverse = np.unique(at, return_inverse=True)
    return places, np.bincount(inverse, np.concatenate((damped, shares, np.ones(len(more)))))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class Ordinal:
    """Weights by bucket and the rising thresholds between grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def at_most(self, scores: np.ndarray) -> np.ndarray:
        """P(grade <= k) for each threshold k, one row per score."""
        return sigmoid(self.thresholds[None, :] - scores[:, None])

    def expected(self, scores: np.ndarray) -> np.ndarray:
        return (1 - self.at_most(scores)).sum(axis=1)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int,
        steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> Ordinal:
    """Adam on the cumulative-link likelihood; whole sample per step. The
    first threshold is free, the others lie a positive gap above it."""
    weights = np.zeros(BUCKETS)
    share = (np.bincount(grades, minlength=n_grades).cumsum()[:-1] + 0.5) / (len(grades) + 1.0)
    cuts = np.log(share / (1 - share))
    gaps = np.concatenate((cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))))
    if not len(rows):
        return Ordinal(weights, cuts)
    used, place = np.unique(np.concatenate([a for a, _ in rows]), return_inverse=True)
    value = np.concatenate([v for _, v in rows])
    row = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])
    w = np.zeros(len(used))
    moments = [np.zeros_like(x) for x in (w, gaps, w, gaps)]
    n = len(rows)
    for t in range(1, steps + 1):
        theta = gaps[0] + np.concatenate(([0.0], np.cumsum(np.exp(gaps[1:]))))
        score = np.bincount(row, value * w[place], n)
        below = np.concatenate((np.full((n, 1), 0.0), sigmoid(theta[None, :] - score[:, None]), np.full((n, 1), 1.0)), axis=1)
        hi, lo = below[np.arange(n), grades + 1], below[np.arange(n), grades]
        p = np.maximum(hi - lo, 1e-12)
        slope = below * (1 - below)  # of each boundary by its threshold
        s_hi, s_lo = slope[np.arange(n), grades + 1] / p, slope[np.arange(n), grades] / p
        d_score = (s_hi - s_lo) / n  # of the negative log-likelihood
        d_theta = np.zeros(n_grades + 1)
        np.add.at(d_theta, grades + 1, -s_hi / n)
        np.add.at(d_theta, grades, s_lo / n)
        d_theta = d_theta[1:-1]
        tail = np.cumsum(d_theta[::-1])[::-1]
        d_gaps = np.concatenate((tail[:1], tail[1:] * np.exp(gaps[1:])))
        d_w = np.bincount(place, value * d_score[row], len(used)) + penalty * w / n
        for k, (x, d) in enumerate(((w, d_w), (gaps, d_gaps))):
            moments[k] = 0.9 * moments[k] + 0.1 * d
            moments[k + 2] = 0.999 * moments[k + 2] + 0.001 * d * d
            x -= rate * (moments[k] / (1 - 0.9 ** t)) / (np.sqrt(moments[k + 2] / (1 - 0.999 ** t)) + 1e-8)
    weights[used] = w
    theta = gaps[0] + np.concatenate(([0.0], np.cumsum(np.exp(gaps[1:]))))
    return Ordinal(weights, theta)


class _Words(dict):
    """Weights of a word: of its spelling and of its shape."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.w = weights

    def __missing__(self, word: bytes) -> tuple[float, float]:
        a, b = features(word)
        v = float(self.w[a]), float(self.w[b])
        if len(self) < CACHE_WORDS:  # frequent words come early
            self[word] = v
        return v


def text_score(words: _Words, text: str | None) -> float:
    """The logit of a text; no words: 0."""
    ws = (text or "").encode("utf-8", "surrogatepass").split()
    if not ws:
        return 0.0
    kinds, damped, shares = word_shares(ws)
    own = np.array([words[w] for w in kinds])
    return float(own[:, 0] @ damped + own[:, 1] @ shares) + sum([float(words.w[k]) for k in repeat_buckets(ws)])


def rated_sample(docs: DataFrame, ratings: DataFrame, id_col: str, text: str, grade: str, n_grades: int,
                 sample: int = SAMPLE) -> tuple[list, np.ndarray]:
    """At most ``sample`` rated documents: those whose ids hash lowest. One
    rated more than once takes its lowest grade; ratings outside 0..n_grades-1
    or null are left out. Of documents that share an id the text that hashes
    lowest is learnt from, in whatever order they come."""
    spark = docs.sparkSession
    chosen = (ratings.select(F.col(id_col).alias("_id"), F.col(grade).cast("int").alias("_grade"))
              .where(F.col("_id").isNotNull() & F.col("_grade").between(0, n_grades - 1))
              .groupBy("_id").agg(F.min("_grade").alias("_grade"))
              .orderBy(F.xxhash64("_id"), "_id").limit(sample))
    picked = spark.createDataFrame(chosen.toArrow(), schema=chosen.schema)  # bounded by ``sample``
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text")).join(F.broadcast(picked), "_id")
    rows = (rows.groupBy("_id").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text"),
                                    F.first("_grade").alias("_grade")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [text_features(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.string()), b.column(2), pa.array([a.tolist() for a, _ in got], pa.list_(pa.int32())),
                 pa.array([v.astype(np.float32).tolist() for _, v in got], pa.list_(pa.float32()))],
                names=["id", "grade", "at", "value"])

    t = (rows.mapInArrow(run, "id string, grade int, at array<int>, value array<float>")
         .toArrow().sort_by("id"))
    feats = [(np.array(a, np.int64), np.array(v)) for a, v in zip(t["at"].to_pylist(), t["value"].to_pylist(), strict=True)]
    return feats, np.array(t["grade"].to_pylist(), np.int64)


def train(docs: DataFrame, ratings: DataFrame, n_grades: int, id_col: str = "doc_id", text: str = "text",
          grade: str = "grade", sample: int = SAMPLE) -> Ordinal:
    """Fit on rated documents. Without any the thresholds are even."""
    ship(docs.sparkSession)
    rows, grades = rated_sample(docs, ratings, id_col, text, grade, n_grades, sample)
    return fit(rows, grades, n_grades)


def with_quality(docs: DataFrame, model: Ordinal, text: str = "text", grades: tuple[int, ...] = (1,),
                 names: tuple[str, ...] = ("expected_grade", "p_good")) -> DataFrame:
    """``docs`` with the expected grade and P(grade >= g) of each row for each
    g of ``grades``; ``names`` are the new columns. Null texts and texts without words have score 0 (the thresholds
    alone decide). Texts stay in their task."""
    ship(docs.sparkSession)
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        words = worker_state("quality", m.thresholds.tobytes() + m.weights[m.weights != 0].tobytes(),
                             lambda: _Words(m.weights))
        for b in batches:
            s = np.array([text_score(words, x.as_py()) for x in b.column(at)], np.float64)
            tails = [1 - m.at_most(s)[:, g - 1] if len(s) else s for g in grades]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(m.expected(s) if len(s) else s), *map(pa.array, tails)],
                                             names=[*b.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    return docs.mapInArrow(run, schema)


# ------------------------------------------------------- the driver's tables

#: Grades of the ratings table: poor, good but toxic, good.
GRADES = 3
LEAST_GRADE = 1
LEAST_PROBABILITY = 0.5


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of (doc_id, quality, toxic): 0 poor, 1 good but toxic, 2 good."""
    g: Column = F.when(F.col("quality") < 1, 0).when(F.col("toxic") >= 1, 1).when(F.col("quality").isNotNull(), 2)
    return labels.select("doc_id", g.alias("grade"))


def quality_table(docs: DataFrame, labels: DataFrame, least_probability: float = LEAST_PROBABILITY) -> DataFrame:
    """One row per document: id, expected grade, ``p_good`` = P(grade >= 1),
    ``p_clean`` = P(grade >= 2, good and not toxic), and ``selected`` by ``p_good``.

    A null or empty text has score 0: its probabilities are those of the
    thresholds. Rows that repeat get the same values each; documents that share
    an id are judged each by its own text. Without ratings the thresholds are
    even; an empty table gives an empty result; other columns are not read.
    """
    model = train(docs, graded(labels), GRADES)
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("_text"))
    out = with_quality(rows, model, "_text", (LEAST_GRADE, GRADES - 1), ("expected_grade", "p_good", "p_clean"))
    return out.select("doc_id", "expected_grade", "p_good", "p_clean", (F.col("p_good") >= least_probability).alias("selected"))


def quality_filter(docs: DataFrame, labels: DataFrame, least_probability: float = LEAST_PROBABILITY) -> DataFrame:
    """The rows of ``docs`` whose P(grade >= 1) is high enough, with their own
    columns, whatever those are called. Null and empty texts are judged by the
    thresholds alone, repeated rows each; an empty table stays empty. Toxic
    documents of good quality stay: the stage judges quality."""
    model = train(docs, graded(labels), GRADES)
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    out = with_quality(plain, model, f"_c{names.index('text')}", (LEAST_GRADE,), ("_expected", "_good"))
    return out.where(F.col("_good") >= least_probability).select(*plain.columns).toDF(*names)

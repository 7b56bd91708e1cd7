"""Toxic passages as maximum-scoring segments of token log-odds.

Learning reads labelled documents whose crc32(doc_id) mod 5 is not 0. Token counts of toxic and
clean training documents give log-odds under a Dirichlet prior whose means are the token
frequencies of *all* documents and which weighs as much as the toxic text. A token's score is the part of its log-odds beyond ``Z`` standard
errors, less a small cost per word, so that a segment grows only over evidence. A linear scan finds every maximal segment of a text. By extreme-value theory the best segment of n clean tokens
exceeds x with probability 1 - exp(-K n exp(-lambda x)); lambda solves sum p exp(lambda s) = 1 over
the corpus, K is fitted to the clean training documents. The evidence of a text is the sum of
lambda s - ln(K n) over its significant segments, and a logistic curve fitted to the training
documents turns it into a score between 0 and 1.

A word's tokens are the word and its beginnings of ``STEMS`` bytes, so that inflected forms share
evidence; a word scores as its most toxic token, or by itself where none is toxic.

Tokens are hashed into ``BUCKETS`` places, so model and broadcasts have a fixed size. At most
``MOST_LABELS`` labelled documents of each class train the model, chosen by a hash of their id;
everything else is counted over all documents.

Null and empty texts have no evidence and get the lowest score; several label rows of one id count
as toxic if one of them says so; null labels and ids do not train; without labels of both classes
every score is the share of toxic labels (half a label more on each side).
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spokewise.llm.common import small_batches
from spokewise.llm.decontaminate import words_of

BUCKETS = 1 << 19
STEMS = (4, 5, 6, 7, 8)
MOST_LABELS = 100_000
Z = 1.96
COST = 0.1
#: Segments that score less are noise at any text length and not reported.
LEAST_SEGMENT = 1.0
#: Steps a unit in the histogram of word scores.
STEPS = 20
#: A worker forgets its word numbers beyond so many words.
MOST_WORDS_KNOWN = 1 << 18

RESULT = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("evidence", T.DoubleType()),
        T.StructField("best", T.DoubleType()),
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "passages",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("first", T.LongType()),
                        T.StructField("last", T.LongType()),
                        T.StructField("score", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)


@dataclass
class Model:
    scores: np.ndarray  # float32, one per bucket
    scale: float  # lambda
    log_k: float
    intercept: float
    slope: float


def held_out() -> Column:
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(digest % 5 == 0, F.lit(False))


def tokens(word: bytes) -> list[int]:
    """Buckets of a word and its beginnings, the word first."""
    return [zlib.crc32(word) % BUCKETS] + [
        zlib.crc32(word[:n], n) % BUCKETS for n in STEMS if n <= len(word)
    ]


class WordScores(dict):
    """Score of a word under a table of token scores, remembered."""

    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table = table.tolist()

    def __missing__(self, word: bytes) -> float:
        if len(self) >= MOST_WORDS_KNOWN:
            self.clear()
        table = self.table
        of = [table[place] for place in tokens(word)]
        best = max(of)
        self[word] = value = best if best > -COST else of[0]
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.float32, len(words))


def training_labels(labels: DataFrame, most: int = MOST_LABELS) -> DataFrame:
    """(label_id, toxic): at most ``most`` training rows of each class, the same in every run."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    one = usable.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    classes = [one.where(F.col("toxic") == c).orderBy(*order).limit(most) for c in (0, 1)]
    return classes[0].union(classes[1]).withColumnRenamed("doc_id", "label_id")


def _counts(documents: DataFrame, sample: DataFrame) -> DataFrame:
    """(bucket, n, n_toxic, n_clean): occurrences in all, toxic and clean training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, BUCKETS), dtype=np.int64)

        def add(row: int, counter: Counter) -> None:
            if not counter:
                return
            places = [tokens(word) for word in counter]
            sizes = np.fromiter(map(len, places), np.int64, len(places))
            at = np.fromiter(chain.from_iterable(places), np.int64, int(sizes.sum()))
            times = np.repeat(np.fromiter(counter.values(), np.int64, len(counter)), sizes)
            np.add.at(total[row], at, times)
            counter.clear()

        counters = [Counter(), Counter(), Counter()]
        for batch in small_batches(batches):
            texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, wanted in ((1, 1), (2, 0), (0, None)):
                counters[row].update(words_of(b" ".join(t for t, y in zip(texts, toxic) if t and y == wanted)))
                if len(counters[row]) > MOST_WORDS_KNOWN:
                    add(row, counters[row])
        for row, counter in enumerate(counters):
            add(row, counter)
        total[0] += total[1] + total[2]
        at = np.flatnonzero(total[0])
        for begin in range(0, len(at), 65536):
            part = at[begin : begin + 65536]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), *(pa.array(total[k, part]) for k in range(3))],
                names=["bucket", "n", "n_toxic", "n_clean"],
            )

    labelled = documents.select(F.col("doc_id").alias("label_id"), F.col("text").cast("binary").alias("body"))
    joined = labelled.join(F.broadcast(sample), "label_id", "left").select("body", "toxic")
    partial = joined.mapInArrow(run, "bucket long, n long, n_toxic long, n_clean long")
    return partial.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("n", "n_toxic", "n_clean")))


def _token_scores(counts: np.ndarray) -> np.ndarray:
    """Scores of the buckets from counts (all, toxic, clean) per bucket."""
    n, toxic, clean = counts.astype(float)
    if not toxic.sum() or not clean.sum():
        return np.full(BUCKETS, -COST, dtype=np.float32)
    prior = toxic.sum() * (n + 0.5) / (n + 0.5).sum()
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    beyond = np.maximum(np.abs(odds) - Z * np.sqrt(1 / a + 1 / b), 0)
    return (np.sign(odds) * beyond - COST).astype(np.float32)


def _histogram(documents: DataFrame, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word scores, in steps of 1/STEPS, and how often each occurs in all documents."""
    shared = documents.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = WordScores(shared.value), Counter()
        for batch in small_batches(batches):
            joined = b" ".join(t for t in batch.column(0).to_pylist() if t)
            for word, times in Counter(words_of(joined)).items():
                total[round(known[word] * STEPS)] += times
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["step", "n"]
        )

    partial = documents.select(F.col("text").cast("binary")).mapInArrow(run, "step long, n long")
    rows = partial.groupBy("step").agg(F.sum("n").alias("n")).collect()
    return np.array([r[0] / STEPS for r in rows]), np.array([r[1] for r in rows])


def _scale(scores: np.ndarray, n: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1."""
    s, p = scores.astype(float), n / max(1, n.sum())
    if not len(s) or s.max() <= 0 or (p * s).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (p * np.exp(np.minimum(high * s, 700))).sum() < 1 and high < 1e3:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(np.minimum(middle * s, 700))).sum() < 1 else (low, middle)
    return high


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), by one scan over alternating runs.

    Each candidate keeps the total before it and at its end; a new one merges with earlier ones as
    long as their joint score is above both parts.
    """
    if not len(scores) or scores.max() <= 0:
        return []
    positive = scores > 0
    cut = np.concatenate(([0], np.flatnonzero(positive[1:] != positive[:-1]) + 1))
    ends = np.append(cut[1:], len(scores))
    total = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    keep: list[tuple[int, int, float, float]] = []  # first, end, total before, total at the end
    below: list[int] = []  # for each kept one, the last before it with a smaller total before
    for a, b in zip(cut[positive[cut]].tolist(), ends[positive[cut]].tolist()):
        left, right = total[a], total[b]
        while True:
            j = len(keep) - 1
            while j >= 0 and keep[j][2] >= left:
                j = below[j]
            if j < 0 or keep[j][3] >= right:
                keep.append((a, b, left, right))
                below.append(j)
                break
            a, left = keep[j][0], keep[j][2]
            del keep[j:], below[j:]
    return [(a, b - 1, float(r - l)) for a, b, l, r in keep]


def score(documents: DataFrame, model: Model, keep: list[str], result: str = "toxicity") -> DataFrame:
    """The columns ``keep`` and a struct ``result``.

    It has the score, the evidence, the best segment's score, the number of words, and the
    significant passages (first word, last word, segment score). One pass, no shuffle. A kept column
    named like ``result`` gives way to it.
    """
    keep = [c for c in keep if c != result]
    shared = documents.sparkSession.sparkContext.broadcast(
        (model.scores, model.scale, model.log_k, model.intercept, model.slope)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, scale, log_k, intercept, slope = shared.value
        known = WordScores(table)
        names = [f.name for f in RESULT.fields]
        for batch in small_batches(batches):
            out: list[list] = [[] for _ in names]
            for text in batch.column(batch.num_columns - 1).to_pylist():
                words = words_of(text)
                found = segments(known.of(words))
                bar = log_k + math.log(len(words)) if words else 0.0
                strong = [s for s in found if s[2] >= LEAST_SEGMENT and scale * s[2] > bar]
                evidence = sum(scale * s[2] - bar for s in strong)
                z = max(-700.0, min(700.0, intercept + slope * evidence))
                best = max((s[2] for s in found), default=0.0)
                row = (1 / (1 + math.exp(-z)), evidence, best, len(words))
                for column, value in zip(out, (*row, [dict(zip(("first", "last", "score"), s)) for s in strong])):
                    column.append(value)
            kinds = [pa.float64(), pa.float64(), pa.float64(), pa.int64()]
            passage = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())])
            struct = pa.StructArray.from_arrays(
                [pa.array(v, k) for v, k in zip(out, [*kinds, pa.list_(passage)])], names=names
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], struct], names=[*keep, result])

    schema = T.StructType([*[documents.schema[c] for c in keep], T.StructField(result, RESULT)])
    return documents.select(*keep, F.col("text").cast("binary").alias("__body")).mapInArrow(run, schema)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton's method with a weak pull to zero; the slope is not negative."""
    beta, design = np.zeros(2), np.stack((np.ones_like(x), x), axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 1e-3 * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(max(0.0, beta[1]))


def fit(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> Model:
    """Three passes: token counts and word scores of all documents, segments of the training ones."""
    sample = training_labels(labels, most)
    counts = np.zeros((3, BUCKETS), dtype=np.int64)
    for row in _counts(documents, sample).toLocalIterator():
        counts[:, row[0]] = row[1:]
    scores = _token_scores(counts)
    model = Model(scores, _scale(*_histogram(documents, scores)), 0.0, 0.0, 0.0)
    ids = documents.select(F.col("doc_id").alias("label_id"), "text")
    training = ids.join(F.broadcast(sample), "label_id")
    seen = score(training, model, ["toxic"]).select("toxic", "toxicity.*")
    clean = seen.where("toxic = 0 AND n_words > 0").agg(
        F.avg(F.lit(model.scale) * F.col("best") - F.log(F.col("n_words"))), F.count("*")
    )
    mean = clean.first()[0]
    model.log_k = float(mean) - float(np.euler_gamma) if mean is not None else 0.0
    seen = score(training, model, ["toxic"]).select("toxic", "toxicity.*")
    step = F.floor(F.col("evidence") * 4) / 4
    table = seen.groupBy("toxic", F.least(step, F.lit(1e4)).alias("x")).count().collect()
    y, x, w = (np.array([float(r[k]) for r in table]) for k in ("toxic", "x", "count"))
    if len(set(y)) == 2:
        model.intercept, model.slope = _logistic(x, y, w)
    else:
        toxic = float((w * y).sum())
        model.intercept = math.log((toxic + 0.5) / (float(w.sum()) - toxic + 0.5))
    return model

"""Quality classifier: ordinal regression on graded ratings, with one set of hashed-text weights.

A document's score is the dot product of its hashed features with shared weights; ordered thresholds turn
it into the chance of each grade, P(grade >= k) = logistic(score - threshold k). Features are the words and
their last three bytes, hashed into `bins`, counted and scaled to length one. Grades: 0 for low quality, 1
for good quality that is toxic, 2 for good and clean; a document is selected if its chance of the top
grade reaches `least_chance`.

The fit reads at most `sample_rows` labelled documents (those with the least hash of their id, a bounded
sample); scoring reads every document, and the model that its tasks get is `bins` numbers.

Defined results: null or empty text has score 0. A label with a null in it is left out; several labels of
a document count as the worst. With fewer than two different grades in the labels there is no model, and
all results but doc_id are null. Repeated rows are scored one by one and alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldloom.llm.word_hashes import stretches, word_hashes

BINS = 1 << 17
SAMPLE_ROWS = 8192
EPOCHS = 12
BATCH = 64
RATE = 0.5
LEAST_CHANCE = 0.35
GRADES = 3


def features(column: pa.Array, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document the distinct bins (concatenated), their values, and where each document's begin."""
    w = word_hashes(column, lower=True)
    tail = np.zeros(len(w.start), dtype=np.uint64)
    for back in range(1, 4):
        at = w.end - back
        tail = tail * np.uint64(257) + np.where(at >= w.start, w.data[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
    tail = (tail * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first)).astype(np.uint64)
    half = np.uint64(bins // 2)
    keys = np.concatenate([doc * np.uint64(bins) + w.hashes % half, doc * np.uint64(bins) + half + tail % half])
    keys, counts = np.unique(keys, return_counts=True)
    docs, at = (keys // np.uint64(bins)).astype(np.int64), (keys % np.uint64(bins)).astype(np.int64)
    begin = np.searchsorted(docs, np.arange(len(w.first)))
    values = np.log1p(counts)
    norms = np.sqrt(np.bincount(docs, values**2, minlength=len(w.first) - 1))
    return at, values / np.maximum(norms[docs], 1e-12), begin


def dots(at: np.ndarray, values: np.ndarray, begin: np.ndarray, weights: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(weights[at] * values)])
    return sums[begin[1:]] - sums[begin[:-1]]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., a column each."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def features_in_parts(column: pa.Array, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`features`, a stretch of the texts at a time."""
    parts = [features(column.slice(lo, hi - lo), bins) for lo, hi in stretches(column)]
    begin = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[2]) for p in parts]))])
    return np.concatenate([p[0].astype(np.int32) for p in parts]), np.concatenate([p[1].astype(np.float32) for p in parts]), begin


def fit(column: pa.Array, grades: np.ndarray, bins: int = BINS, levels: int = GRADES, epochs: int = EPOCHS, rate: float = RATE) -> Ordinal:
    """Minimises the negative log likelihood of the grades by AdaGrad on small batches, in a fixed random order.

    Thresholds are the first one plus exponentials of free numbers, so they stay in order.
    """
    at, values, begin = features_in_parts(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, bins)
    weights, past = np.zeros(bins), np.full(bins, 1e-3)
    free, free_past = np.zeros(levels - 1), np.full(levels - 1, 1e-3)
    shares = np.array([(grades >= k).mean() for k in range(1, levels)]).clip(0.01, 0.99)
    cuts = -np.log(shares / (1 - shares))
    free[0], free[1:] = cuts[0], np.log(np.maximum(np.diff(cuts), 0.05))
    order = np.random.default_rng(5)
    for _ in range(epochs):
        rows = order.permutation(len(grades))
        for lo in range(0, len(rows), BATCH):
            part = rows[lo : lo + BATCH]
            spans = [np.arange(begin[i], begin[i + 1]) for i in part]
            own = np.repeat(np.arange(len(part)), [len(s) for s in spans])
            spans = np.concatenate(spans)
            score = np.bincount(own, weights[at[spans]] * values[spans], minlength=len(part))
            thresholds = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
            tail = _logistic(score[:, None] - thresholds)
            ahead = np.concatenate([np.ones((len(part), 1)), tail, np.zeros((len(part), 1))], axis=1)
            slope = ahead * (1 - ahead)
            each, g = np.arange(len(part)), grades[part]
            chance = np.maximum(ahead[each, g] - ahead[each, g + 1], 1e-9)
            by_score = -(slope[each, g] - slope[each, g + 1]) / chance
            by_cut = np.zeros((len(part), levels + 1))
            by_cut[each, g] += slope[each, g] / chance
            by_cut[each, g + 1] -= slope[each, g + 1] / chance
            to_cuts = by_cut[:, 1:levels].mean(axis=0)
            step = np.array([to_cuts[k:].sum() for k in range(levels - 1)]) * np.concatenate([[1.0], np.exp(free[1:])])
            grad = np.bincount(at[spans], by_score[own] * values[spans] / len(part), minlength=0)
            hit = np.flatnonzero(grad)
            past[hit] += grad[hit] ** 2
            weights[hit] -= rate * grad[hit] / np.sqrt(past[hit])
            free_past += step**2
            free -= 0.1 * step / np.sqrt(free_past)
    return Ordinal(weights.astype(np.float32), np.cumsum(np.concatenate([free[:1], np.exp(free[1:])])))


def graded_sample(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and grade of at most `sample_rows` labelled documents."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    graded = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg(F.min(grade).alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(graded), "doc_id")
    return texts.groupBy("doc_id").agg(F.min(F.struct("text", "grade")).alias("x")).select("doc_id", "x.text", "x.grade")


def trained(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, bins: int = BINS) -> Ordinal | None:
    sample = graded_sample(docs, labels, sample_rows).orderBy("doc_id").toArrow()
    grades = sample.column("grade").to_numpy()
    return fit(sample.column("text"), grades, bins) if len(np.unique(grades)) > 1 else None


def scored(docs: DataFrame, model: Ordinal | None, least_chance: float = LEAST_CHANCE) -> DataFrame:
    """doc_id, expected_grade, p_good (grade 1 or more), p_top (grade 2) and selected, one row per row of `docs`."""
    schema = "doc_id long, expected_grade double, p_good double, p_top double, selected boolean"
    if model is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in schema.split(", ")[1:])])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo, hi in stretches(whole.column(1)):
                batch = whole.slice(lo, hi - lo)
                tails = model.tails(dots(*features(batch.column(1), len(model.weights)), model.weights))
                # rounded so that results do not depend on how rows are batched
                tails = np.round(tails, 6)
                columns = [batch.column(0).cast(pa.int64()), pa.array(tails.sum(axis=1)), pa.array(tails[:, 0]), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= least_chance)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "expected_grade", "p_good", "p_top", "selected"])

    return docs.select("doc_id", "text").mapInArrow(score, schema)


def selected(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, least_chance: float = LEAST_CHANCE) -> DataFrame:
    return scored(docs, trained(docs, labels, sample_rows), least_chance)

"""Quality of texts by naive Bayes support vectors.

Words and pairs of words are hashed into ``FEATURES`` indicators, and so are the pairs
that are one word twice, whatever the word, once for each power of two they reach. Each is scaled by its
log-count ratio between the classes, rows are brought to unit length, and a linear model
with hinge loss is fitted by dual coordinate descent. A logistic curve, fitted on rows
that the descent has not seen, turns margins into scores.

Fitting takes at most ``SAMPLE_ROWS`` labelled rows, those with the smallest hash of
their id, so it fits one task at any size of the corpus; their ids are what is
broadcast. Scoring is one pass over all texts, without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import raw_values

FEATURES = 1 << 17
SAMPLE_ROWS = 12_000
#: Penalty of the hinge loss, and passes over the rows.
PENALTY = 4.0
PASSES = 12
SMOOTHING = 1.0
#: One row in so many is kept from the descent, for the logistic curve.
CURVE_EVERY = 5
_PAIR = np.uint64(0x9E3779B1)
_TWICE = np.uint64(1 << 40)


class Model(NamedTuple):
    """Weight and squared ratio of each indicator, the constant, and the curve from margin to score."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, features: np.ndarray) -> float:
        length = np.sqrt(self.squares[features].sum())
        return float(self.weights[features].sum() / length + self.bias) if length else self.bias

    def score(self, text: bytes) -> float:
        height = self.slope * self.margin(indicators(text)) + self.shift
        return float(1 / (1 + np.exp(-np.clip(height, -500, 500))))

    def packed(self) -> bytes:
        return np.concatenate([[self.bias, self.slope, self.shift], self.weights, self.squares]).tobytes()


def unpacked(model: bytes) -> Model:
    numbers = np.frombuffer(model)
    return Model(numbers[3 : 3 + FEATURES], numbers[3 + FEATURES :], *map(float, numbers[:3]))


def indicators(text: bytes) -> np.ndarray:
    """Distinct features of a text: its words, pairs of neighbours and steps of repetition, hashed."""
    words = np.array(list(map(zlib.crc32, text.split())), dtype=np.uint64)
    pairs = words[:-1] * _PAIR + words[1:]
    twice = int((words[:-1] == words[1:]).sum())
    steps = np.arange(twice.bit_length(), dtype=np.uint64) + _TWICE
    mixed = np.concatenate([words, pairs ^ (pairs >> np.uint64(29)), steps])
    seen = np.zeros(FEATURES, dtype=bool)
    seen[(mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 17)] = True
    return np.flatnonzero(seen)


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """log of the share of each feature in class 1 over its share in class 0."""
    counts = [np.full(FEATURES, SMOOTHING), np.full(FEATURES, SMOOTHING)]
    for features, label in zip(rows, labels, strict=True):
        counts[int(label)][features] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def _scaled(features: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    values = ratios[features]
    length = np.sqrt((values * values).sum())
    return values / length if length else values


def descend(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and constant of the hinge-loss model, by dual coordinate descent."""
    weights, bias = np.zeros(FEATURES), 0.0
    scaled = [_scaled(features, ratios) for features in rows]
    norms = [float((values * values).sum()) + 1.0 for values in scaled]
    signs = np.where(labels == 1, 1.0, -1.0)
    alphas = np.zeros(len(rows))
    order = np.random.default_rng(0)
    for _ in range(PASSES):
        largest = 0.0
        for i in order.permutation(len(rows)):
            features, values = rows[i], scaled[i]
            gradient = signs[i] * (weights[features] @ values + bias) - 1.0
            moved = min(max(alphas[i] - gradient / norms[i], 0.0), PENALTY)
            step = moved - alphas[i]
            if step:
                weights[features] += step * signs[i] * values
                bias += step * signs[i]
                alphas[i] = moved
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return weights, bias


def _curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve by Newton's method; a rising curve always."""
    slope, shift = 1.0, 0.0
    n1 = labels.sum()
    n0 = len(labels) - n1
    aims = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-(slope * margins + shift)))
        g = np.array([((p - aims) * margins).sum() + 1e-3 * (slope - 1), (p - aims).sum()])
        w = p * (1 - p)
        h = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return (slope, shift) if slope > 0 and np.isfinite([slope, shift]).all() else (1.0, 0.0)


def fitted(texts: list[bytes], labels: np.ndarray) -> Model:
    """The model of labelled texts; with one class only, or no text, every score is the same."""
    nothing = np.zeros(FEATURES)
    if len(set(labels.tolist())) < 2:
        return Model(nothing, nothing, 0.0, 1.0, float(40 * labels.mean() - 20) if len(labels) else 0.0)
    rows = [indicators(text) for text in texts]
    held = np.arange(len(rows)) % CURVE_EVERY == CURVE_EVERY - 1
    if len(set(labels[~held].tolist())) < 2:
        held[:] = False
    kept = [row for row, out in zip(rows, held, strict=True) if not out]
    ratios = log_count_ratios(kept, labels[~held])
    weights, bias = descend(kept, labels[~held], ratios)
    model = Model(weights * ratios, ratios * ratios, bias, 1.0, 0.0)
    judged = held if held.any() else ~held
    margins = np.array([model.margin(row) for row, wanted in zip(rows, judged, strict=True) if wanted])
    slope, shift = _curve(margins, labels[judged])
    return model._replace(slope=float(slope), shift=float(shift))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model of labelled documents.

    ``labels`` has (doc_id, quality); of several rows of a document the larger label
    counts, and of several texts with one id the last by content. Null ids, null labels
    and labels other than 0 and 1 are left out; null texts are empty.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
    by_id = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("quality").cast("int").alias("label"))
    sample = by_id.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    # at most ``sample_rows`` ids and labels
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    texts = texts.select(F.col("_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            row
            for batch in batches
            for row in zip(
                batch.column(0).to_pylist(), raw_values(batch.column(1)), batch.column(2).to_pylist(), strict=True
            )
        )
        once = {doc_id: (text, label) for doc_id, text, label in rows}
        chosen = [text for text, _ in once.values()]
        model = fitted(chosen, np.array([label for _, label in once.values()], dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([model.packed()], pa.binary())], names=["model"])

    # the sample fits one task by its bound
    found = texts.repartition(1).mapInArrow(run, "model binary").first()
    return unpacked(bytes(found["model"])) if found else fitted([], np.zeros(0, dtype=np.int64))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs``.

    Null and empty texts have the score of the constant alone. Rows that repeat score
    alike; other columns are left out; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(text) for text in raw_values(batch.column(1))], dtype=np.float64)
            columns = [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, score double, predicted int")

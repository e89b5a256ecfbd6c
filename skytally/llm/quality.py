"""Ordinal quality grades from hashed text: a cumulative-link regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skytally.llm.labelled import labelled_sample, word_hashes

WORD_CELLS = 1 << 15
SHAPE_CELLS = 512  # three neighbouring bytes by class
FRESH_CELLS = 11  # share of distinct words in tenths
LENGTH_CELLS = 8
CELLS = WORD_CELLS + SHAPE_CELLS + FRESH_CELLS + LENGTH_CELLS
STEPS, RATE, SHRINK = 250, 0.1, 1e-5
MAX_GRADED = 4_000
LEAST_GRADED = 20  # fewer graded documents train nothing

RESULT = "doc_id long, expected_grade double, tail_probability double, selected boolean"


def _byte_classes() -> np.ndarray:
    """0 white space, 1 lower, 2 upper, 3 digit, 4 closing marks, 5 other marks, 6 beyond ASCII, 7 control."""
    classes = np.full(256, 5, np.int64)
    for cells, value in ((range(32), 7), ((9, 10, 11, 12, 13, 32), 0), (range(97, 123), 1), (range(65, 91), 2),
                         (range(48, 58), 3), (b".,;:'\"", 4), (range(128, 256), 6)):
        classes[list(cells)] = value
    return classes


_CLASS = _byte_classes()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """``(cells, values)``: shares of hashed words and of byte-class triples, and marks of freshness and length."""
    words = word_hashes(text)
    cells, values = [], []
    if len(words):
        cells.append((words % np.uint64(WORD_CELLS)).astype(np.int64))
        values.append(np.full(len(words), 1 / len(words)))
    codes = _CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    if len(codes) > 2:
        counts = np.bincount(codes[:-2] * 64 + codes[1:-1] * 8 + codes[2:], minlength=SHAPE_CELLS)
        at = np.flatnonzero(counts)
        cells.append(WORD_CELLS + at)
        values.append(4 * counts[at] / counts.sum())
    fresh = round(10 * len(np.unique(words)) / len(words)) if len(words) else 0
    length = min(len(words).bit_length() // 2, LENGTH_CELLS - 1)
    cells.append(np.array([WORD_CELLS + SHAPE_CELLS + fresh, CELLS - LENGTH_CELLS + length]))
    values.append(np.array([0.5, 0.25]))
    return np.concatenate(cells), np.concatenate(values)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    """P(grade > k) = sigmoid(score - thresholds[k]); the weights are shared by all thresholds, which ascend."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, text: str) -> float:
        cells, values = features(text)
        return float(self.weights[cells] @ values)

    def tails(self, score: float) -> np.ndarray:
        return _sigmoid(score - self.thresholds)


def fit_ordinal(texts: list[str], grades: list[int], steps: int = STEPS, seed: int = 7) -> OrdinalModel:
    """Maximum likelihood by Adam over the whole sample; thresholds are a first one and positive gaps."""
    y = np.asarray(grades)
    top = int(y.max(initial=0))
    rows = [features(t) for t in texts]
    owner = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
    cells = np.concatenate([c for c, _ in rows]) if rows else np.empty(0, np.int64)
    values = np.concatenate([v for _, v in rows]) if rows else np.empty(0)
    above = np.array([(y > k).mean() if len(y) else 0.5 for k in range(max(top, 1))]).clip(1e-3, 1 - 1e-3)
    start = -np.log(above / (1 - above))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    params = np.r_[np.random.default_rng(seed).normal(0, 1e-3, CELLS), start[0], gaps]
    if len(y) < LEAST_GRADED or len(set(grades)) < 2:
        params[:CELLS] = 0
        return OrdinalModel(params[:CELLS], start)
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        thresholds = np.cumsum(np.r_[params[CELLS], np.exp(params[CELLS + 1 :])])
        score = np.bincount(owner, params[cells] * values, minlength=len(y))
        edges = np.c_[np.full(len(y), 1.0), _sigmoid(score[:, None] - thresholds), np.zeros(len(y))]
        slopes = edges * (1 - edges)
        at = np.arange(len(y))
        chance = np.maximum(edges[at, y] - edges[at, y + 1], 1e-9)
        by_score = -(slopes[at, y] - slopes[at, y + 1]) / chance / len(y)
        by_edge = np.zeros(len(thresholds) + 2)
        np.add.at(by_edge, y, slopes[at, y] / chance / len(y))
        np.add.at(by_edge, y + 1, -slopes[at, y + 1] / chance / len(y))
        by_threshold = by_edge[1:-1]
        behind = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.r_[
            np.bincount(cells, by_score[owner] * values, minlength=CELLS) + SHRINK * params[:CELLS],
            behind[0], behind[1:] * np.exp(params[CELLS + 1 :])]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        params -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return OrdinalModel(params[:CELLS], np.cumsum(np.r_[params[CELLS], np.exp(params[CELLS + 1 :])]))


def train_quality(documents: DataFrame, labels: DataFrame, grade: Column, limit: int = MAX_GRADED) -> OrdinalModel:
    """Fit on at most ``limit`` graded documents outside fold 0."""
    sample = labelled_sample(documents, labels, grade, limit)
    return fit_ordinal([r[0] for r in sample], [int(r[2]) for r in sample])


def score_quality(documents: DataFrame, model: OrdinalModel, at_least: int = 1, bar: float = 0.5) -> DataFrame:
    """``(doc_id, expected_grade, tail_probability, selected)`` of every whole text.

    The tail probability is P(grade >= ``at_least``); documents are selected at ``bar`` or more. Only the text counts;
    null text is empty text, which has a score too. Rows are scored one by one; ids may be null or repeat.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = np.array([model.tails(model.score(t or "")) for t in batch["text"].to_pylist()]).reshape(
                batch.num_rows, len(model.thresholds))
            tail = tails[:, at_least - 1] if at_least <= tails.shape[1] else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(tails.sum(axis=1)), pa.array(tail), pa.array(tail >= bar)],
                names=["doc_id", "expected_grade", "tail_probability", "selected"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, RESULT)


def select_quality(documents: DataFrame, model: OrdinalModel, at_least: int = 1, bar: float = 0.5) -> DataFrame:
    """The rows of ``documents``, with all their columns, that reach ``bar``."""
    names = documents.columns
    at = documents.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = [at_least <= len(model.thresholds) and
                      bool(model.tails(model.score(t or ""))[at_least - 1] >= bar) for t in batch[at].to_pylist()]
            yield batch.filter(pa.array(chosen, pa.bool_()))

    return documents.mapInArrow(keep, documents.schema).select(*names)

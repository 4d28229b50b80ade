"""Quality scores by Naive Bayes support vectors.

A text's features are indicators of hashed n-grams: one to four consecutive
bytes, and two or three consecutive word shapes (case, length, last mark, and
whether the word repeats one of the two before it).  An indicator is scaled by
its log-count ratio between the classes, the vector by the square root of its
number of n-grams, and a linear model is fitted to the hinge loss by dual
coordinate descent.  A logistic curve on held-back training rows gives the
score.

Training uses a bounded sample of labelled rows (``per_class`` documents of
each class); every document is scored whole, in one pass without a shuffle,
with the broadcast weights (``2 ** BITS`` numbers).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beside_text
from .training import fit_probability, labelled_sample, sigmoid

BITS = 18
_MIX = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D)]


def _slots(codes: np.ndarray, kind: int) -> np.ndarray:
    """32-bit codes to table slots, differently for each kind of n-gram."""
    mixed = (codes ^ (codes >> np.uint32(15))) * _MIX[kind]
    return (mixed ^ (mixed >> np.uint32(13))) * _MIX[(kind + 1) % 6] >> np.uint32(32 - BITS)


def _word_shapes(data: np.ndarray) -> np.ndarray:
    """A code under 256 for each word of a text's bytes."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    begins, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(begins):
        return np.zeros(0, dtype=np.uint32)
    place = np.arange(len(data)) - np.repeat(begins, np.diff(np.append(begins, len(data)))) if begins[0] == 0 else (
        np.arange(len(data)) - np.concatenate((np.zeros(begins[0], dtype=np.int64),
                                               np.repeat(begins, np.diff(np.append(begins, len(data)))))))
    weights = (data.astype(np.uint64) + np.uint64(1)) * np.where(space, np.uint64(0), np.uint64(1))
    weights *= (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1))
    hashes = np.add.reduceat(weights, begins)
    size = ends - begins
    upper = (data >= 65) & (data <= 90)
    uppers = np.add.reduceat(upper.astype(np.int64), begins)
    last = data[ends - 1]
    mark = np.where(np.isin(last, (44, 46)), 1, np.where((last < 48) | ((last > 57) & (last < 65)) | ((last > 90) & (last < 97))
                                                         | ((last > 122) & (last < 127)), 2, 0))
    shape = (np.minimum(size // 4, 3) | mark << 2 | (uppers > 0).astype(np.int64) << 4
             | ((uppers > 1) & (uppers * 2 >= size)).astype(np.int64) << 5)
    same1 = np.concatenate(([False], hashes[1:] == hashes[:-1]))
    same2 = np.concatenate(([False, False], hashes[2:] == hashes[:-2]))[:len(hashes)]
    return (shape | same1.astype(np.int64) << 6 | same2.astype(np.int64) << 7).astype(np.uint32)


def features(text: str, marked: np.ndarray) -> np.ndarray:
    """Slots of the distinct n-grams of a whole text; ``marked`` is a zeroed work table, zeroed again."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    wide = data.astype(np.uint32)
    code = wide
    for n in range(4):
        if n:
            code = code[:-1] << np.uint32(8) | wide[n:]
        if not len(code):
            break
        marked[_slots(code, n)] = True
    shapes = _word_shapes(data)
    code = shapes
    for n in (1, 2):
        if len(code) < 2:
            break
        code = code[:-1] << np.uint32(8) | shapes[n:]
        marked[_slots(code, 3 + n)] = True
    found = np.flatnonzero(marked)
    marked[found] = False
    return found


@dataclass
class Model:
    """Weights per slot (ratio times hinge weight), an offset, and the score's curve."""

    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    def margin(self, slots: np.ndarray) -> float:
        return float(self.weights[slots].sum() / np.sqrt(max(1, len(slots))) + self.offset)

    def score(self, margins: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * np.asarray(margins) + self.shift)


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """log of (smoothed share of class-1 rows with the n-gram) over (that of class 0)."""
    counts = np.full((2, 1 << BITS), smooth)
    for slots, y in zip(rows, labels):
        counts[y, slots] += 1
    n = np.array([(labels == 0).sum(), (labels == 1).sum()])[:, None] + 2 * smooth
    return np.log(counts[1] / n[1]) - np.log(counts[0] / n[0])


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, labels: np.ndarray, cost: float = 1.0,
                            rounds: int = 15, seed: int = 1) -> tuple[np.ndarray, float]:
    """Hinge-loss weights over scaled indicators, and the offset (a constant feature).

    Each step solves one row's dual variable exactly, within 0 and the cost of
    its class; classes weigh the same in total.
    """
    signs = np.where(labels > 0, 1.0, -1.0)
    values = [scale[s] / np.sqrt(max(1, len(s))) for s in rows]
    square = np.array([v @ v + 1.0 for v in values])
    n1 = max(1, int((labels > 0).sum()))
    n0 = max(1, len(labels) - n1)
    bound = cost * np.where(labels > 0, len(labels) / (2 * n1), len(labels) / (2 * n0))
    weights, offset, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        largest = 0.0
        for i in order.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ values[i] + offset) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), bound[i])
            change = (new - alpha[i]) * signs[i]
            if change:
                weights[rows[i]] += change * values[i]
                offset += change
                alpha[i] = new
                largest = max(largest, abs(change))
        if largest < 1e-4:
            break
    return weights, offset


def fit(rows: list[np.ndarray], labels: np.ndarray, sizes: dict[int, int], seed: int = 1) -> Model:
    """A model of feature rows; a fifth of them is held back for the score's curve.

    With a class missing, every score is the (smoothed) share of class 1.
    """
    share = (sizes.get(1, 0) + 1) / (sizes.get(0, 0) + sizes.get(1, 0) + 2)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(1 << BITS, dtype=np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    back = np.random.default_rng(seed).random(len(rows)) < 0.2
    if min((labels[~back] == y).sum() for y in (0, 1)) == 0 or min((labels[back] == y).sum() for y in (0, 1)) == 0:
        back[:] = False
    front = [r for r, b in zip(rows, back) if not b]
    ratios = log_count_ratios(front, labels[~back])
    weights, offset = dual_coordinate_descent(front, ratios, labels[~back], seed=seed)
    model = Model((weights * ratios).astype(np.float32), offset, 1.0, 0.0)
    held = back if back.any() else ~back
    margins = np.array([model.margin(r) for r, h in zip(rows, held) if h])
    model.slope, model.shift = fit_probability(margins, labels[held], sizes)
    return model


def train(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, per_class: int = 2000,
          max_chars: int = 50_000) -> Model:
    """Fit on at most ``per_class`` usable labelled documents of each class (of ``max_chars`` at most)."""
    sample, sizes = labelled_sample(docs, labels, label_col, usable, per_class, max_chars)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.zeros(1 << BITS, dtype=bool)
        for batch in batches:
            slots = [features(t.as_py(), marked).astype("<u4").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(slots, pa.binary())],
                                             ["id", "label", "slots"])

    kind = sample.schema["id"].dataType.simpleString()
    rows = sample.mapInArrow(extract, f"id {kind}, label int, slots binary").collect()  # the bounded sample
    rows.sort(key=lambda r: r["id"])
    return fit([np.frombuffer(r["slots"], dtype="<u4").astype(np.int64) for r in rows],
               np.array([r["label"] for r in rows], dtype=np.int64), sizes)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """The ``keep`` columns and ``score_col`` of every row: the probability of label 1 from the whole
    text.

    Null texts are empty; an empty text has no n-grams, so the offset
    alone is its margin.  Null ids pass through,
    repeated rows keep a row each, other columns are ignored, an empty table
    gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, marked = shared.value, np.zeros(1 << BITS, dtype=bool)
        for column in texts:
            margins = [model.margin(features(t.as_py() or "", marked)) for t in column]
            yield pa.array(model.score(np.array(margins, dtype=float)), pa.float64())

    return beside_text(docs, text_col, keep, score_col, "double", run)

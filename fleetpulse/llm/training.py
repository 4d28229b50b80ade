"""Choosing labelled training rows, and turning margins into probabilities."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Characters of a sample's texts together, per class: what the driver holds at most.
MAX_SAMPLE_CHARS = 30_000_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, per_class: int,
                    max_chars: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """(id, text, label) of at most ``per_class`` documents of each class, and the classes' true sizes.

    ``usable`` (a condition on ``labels``) says which rows may be learned
    from.  Of the documents of at most ``max_chars`` characters (of all, if a
    class has none so short) those with the smallest hashes of their id are
    taken, up to ``MAX_SAMPLE_CHARS`` together (one at least).  Labels other
    than 0 and 1 and null ids are ignored; an id with both labels counts as 1.
    """
    known = (labels.where(usable & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label")))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    lengths = source.select("id", F.length("text").alias("chars")).groupBy("id").agg(F.min("chars").alias("chars"))
    # Lengths first, so that long texts are passed over before rows are taken and not after.
    there = lengths.join(known, "id").withColumn("long", F.col("chars") > max_chars)
    taken = [there.where(F.col("label") == y).orderBy("long", F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)]
    in_order = Window.partitionBy("label").orderBy("long", F.xxhash64("id"), "id")  # over at most per_class rows
    chosen = taken[0].unionByName(taken[1]).withColumns({
        "sum": F.sum("chars").over(in_order), "at": F.row_number().over(in_order), "first": F.first("long").over(in_order)})
    chosen = chosen.where(((F.col("sum") <= MAX_SAMPLE_CHARS) & (F.col("long") == F.col("first"))) | (F.col("at") == 1))
    rows = source.join(F.broadcast(chosen.select("id", "label", "chars")), "id").where(F.length("text") == F.col("chars"))
    return rows.groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label")), sizes


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, dtype=float)))


def fit_probability(margins: np.ndarray, labels: np.ndarray, sizes: dict[int, int], steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve over margins, classes weighted to their true sizes.

    Newton's method on smoothed targets, so separable margins stay finite.
    """
    y = labels.astype(float)
    n1, n0 = max(y.sum(), 1.0), max((1 - y).sum(), 1.0)
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    total = max(1, sizes.get(0, 0) + sizes.get(1, 0))
    share = (sizes.get(1, 0) + 1) / (total + 2)
    weight = np.where(y > 0, share / n1, (1 - share) / n0)
    # In units of the margins' spread, and never uphill: a full step may overshoot where all margins are far from zero.
    middle, spread = float(margins.mean()), max(float(margins.std()), 1e-12)
    x = np.column_stack([(margins - middle) / spread, np.ones(len(margins))])

    def loss(beta: np.ndarray) -> float:
        z = x @ beta
        return float((weight * (np.logaddexp(0, z) - target * z)).sum() + 0.5e-6 * beta[0] ** 2)

    beta = np.array([0.0, np.log(share / (1 - share))])
    now = loss(beta)
    for _ in range(steps):
        p = sigmoid(x @ beta)
        slope = x.T @ (weight * (p - target)) + 1e-6 * beta * (1, 0)
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        while np.abs(step).max() >= 1e-8 and not loss(beta - step) < now:
            step /= 2
        beta = beta - step
        now = loss(beta)
        if np.abs(step).max() < 1e-8:
            break
    slope = max(float(beta[0]) / spread, 1e-3)
    return slope, float(beta[1]) - slope * middle

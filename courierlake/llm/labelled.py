"""Bounded, reproducible samples of labelled rows to fit classifiers on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import label_fold

FOLDS = 5


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """doc_id and `label` (0 or 1) outside the held-out fold; repeated ids take the majority.

    Rows without an id or a label are left out.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    return (
        usable.where(label_fold(F.col("doc_id"), FOLDS) != 0)
        .groupBy("doc_id")
        .agg((F.avg(column) >= 0.5).cast("int").alias("label"))
    )


def sampled(rows: DataFrame, at_most: int, seed: int) -> DataFrame:
    """At most `at_most` rows, those with the smallest hash of their doc_id."""
    return rows.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(at_most)


def held_out(doc_id) -> object:
    return F.coalesce(label_fold(doc_id, FOLDS) == 0, F.lit(False))


def _norm(x: np.ndarray) -> float:
    """A bound of the largest singular value, by power iteration."""
    v = np.ones(x.shape[1], x.dtype)
    for _ in range(30):
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v)
    return 1.05 * float(np.linalg.norm(x @ v))


def logistic_fit(x: np.ndarray, y: np.ndarray, l1: float = 0.0, l2: float = 1e-3, steps: int = 250) -> np.ndarray:
    """Weights (the last one is the bias) of a logistic regression with lasso penalty.

    Accelerated proximal gradient; the bias is not penalised.
    """
    x = np.hstack([x.astype(np.float32), np.ones((len(x), 1), np.float32)])
    y = y.astype(np.float32)
    rate = np.float32(4.0 / (_norm(x) ** 2 / len(x) + 4 * l2))
    l1, l2 = np.float32(l1), np.float32(l2)
    w = z = np.zeros(x.shape[1], np.float32)
    momentum = 1.0
    for _ in range(steps):
        p = np.float32(1) / (np.float32(1) + np.exp(-np.clip(x @ z, -30, 30)))
        grad = x.T @ (p - y) / np.float32(len(x)) + l2 * np.append(z[:-1], np.float32(0))
        new = z - rate * grad
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * l1, 0.0)
        after = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        z = new + np.float32((momentum - 1) / after) * (new - w)
        w, momentum = new, after
    return w

"""Bounded samples of labelled documents for fitting, and a small logistic calibration."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spread import remainder

# Longer documents are scored like all others, but not learned from.
FIT_BYTES = 64 << 10


def fit_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, rows: dict[int, int]
) -> tuple[pd.DataFrame, dict[int, int]]:
    """One text per document and its label, at most ``rows[label]`` per label by the hash of the id; and the number of
    learnable documents per class.

    Rows whose crc32(id) modulo ``modulus`` is ``held_out`` are not learned from, nor null labels. Repeated label rows
    count once; an id with both labels counts in both classes. Only ids that have a text of at most ``FIT_BYTES`` take a
    place in the sample; of several such texts with one id the least is learned from.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & (remainder("doc_id", modulus) != held_out))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .distinct()
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = docs.select("doc_id", "text").where(F.octet_length("text") <= FIT_BYTES)
    present = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    ids = None
    for value in (0, 1):
        own = present.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows[value])
        ids = own if ids is None else ids.unionAll(own)
    # At most ``rows[0] + rows[1]`` ids are broadcast, and as many texts of bounded length come back.
    chosen = texts.join(F.broadcast(ids), "doc_id")
    found = chosen.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label").toPandas()
    found = found.sort_values(["doc_id", "text", "label"], kind="stable").reset_index(drop=True)
    return found, counts


def class_weights(y: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Weights that give each class of a sample its share among all learnable rows."""
    weights = np.ones(len(y))
    for value in (0, 1):
        if (y == value).any():
            weights[y == value] = counts.get(value, 0) / (y == value).sum()
    return weights / max(weights.sum(), 1e-12) * len(y)


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Coefficients with the intercept last, by Newton's method with a small ridge on all but the intercept.

    Labels are smoothed towards one half by less than one row per class, so that separable classes keep finite odds.
    """
    x = np.column_stack([x, np.ones(len(x))])
    target = y * (1 - 2e-3) + 1e-3
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ beta)
        gradient = x.T @ (weights * (p - target)) + penalty * beta
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(beta)), gradient)
        beta = beta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def prior(counts: dict[int, int]) -> float:
    """The share of label 1, with one row of each added."""
    return (counts.get(1, 0) + 1) / (counts.get(0, 0) + counts.get(1, 0) + 2)

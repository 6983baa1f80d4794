"""Bounded labelled samples, and the small solvers that fit models on them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_docs: int = 4000,
    max_chars: int = 20_000,
) -> tuple[list[str], list]:
    """Texts and labels of at most ``max_docs`` rows of ``labels``, in a fixed order.

    The rows are the first by a hash of the id, so the sample does not depend on
    partitioning. Rows without id or label are left out, a repeated id counts
    once, and texts over ``max_chars`` characters are not used to fit. The driver
    gets ``max_docs`` times ``max_chars`` characters at most.
    """
    key = F.xxhash64(F.col(id_column).cast("string"))
    chosen = (
        labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id_column).alias("sample_id"))
        .agg(F.min(label).alias("sample_label"))
        .orderBy(F.xxhash64(F.col("sample_id").cast("string")), "sample_id")
        .limit(max_docs)
    )
    rows = (
        docs.select(F.col(id_column).alias("sample_id"), F.coalesce(F.col(text_column), F.lit("")).alias("sample_text"))
        .where(F.length("sample_text") <= max_chars)
        .join(F.broadcast(chosen), "sample_id")
        .groupBy("sample_id", "sample_label")
        .agg(F.min("sample_text").alias("sample_text"))
        .select(F.xxhash64(F.col("sample_id").cast("string")), "sample_id", "sample_text", "sample_label")
        .collect()
    )
    rows.sort(key=lambda r: (r[0], r[1]))
    return [r[2] for r in rows], [r[3] for r in rows]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def adam(gradient: Callable[[np.ndarray], np.ndarray], start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Minimise by Adam with a rate that falls to a tenth."""
    x, mean, square = start.astype(float), np.zeros_like(start, float), np.zeros_like(start, float)
    for t in range(1, steps + 1):
        g = gradient(x)
        mean = 0.9 * mean + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        step = rate * (1 - 0.9 * t / steps)
        x -= step * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-9)
    return x


def logistic(features: np.ndarray, labels: np.ndarray, penalty: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Dense logistic regression by Newton steps; the last weight is the intercept."""
    x = np.column_stack([features, np.ones(len(labels))])
    weights = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    for _ in range(rounds if len(labels) else 0):
        p = sigmoid(x @ weights)
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(labels) + ridge + 1e-9 * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ (p - labels) / len(labels) + ridge @ weights)
        weights -= np.clip(step, -4, 4)
    return weights

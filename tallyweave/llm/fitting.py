"""Small pieces of model fitting on bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_labels(labels: DataFrame, label: str, training: Column, key: str) -> DataFrame:
    """One 0/1 label per key; several labels of a key count by their mean, 0.5 as 1."""
    chosen = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & training)
    return chosen.groupBy(key).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))


def sampled(known: DataFrame, rows: int, key: str) -> DataFrame:
    """Up to ``rows`` keys with their labels, by a hash of the key."""
    return known.orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(rows)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(rows: np.ndarray, labels: np.ndarray, penalty: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    weights = np.zeros(rows.shape[1])
    for _ in range(rounds):
        p = sigmoid(rows @ weights)
        slope = rows.T @ (p - labels) + penalty * weights
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + penalty * np.eye(len(weights))
        weights -= np.linalg.solve(curve, slope)
    return weights

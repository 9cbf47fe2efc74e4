"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.fitting import mean_labels, sampled, sigmoid

#: Labelled texts that a model is fitted on.
TEXTS = 20_000
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
LEAF_PENALTY = 1.0
#: Sum of second derivatives a child must have.
LEAST_CHILD = 1.0

STATISTICS = (
    "log_chars", "log_words", "mean_word", "longest_word", "upper", "lower", "digit", "symbol", "mark", "exclaim", "other",
    "space", "distinct_words", "top_word", "equal_neighbours", "capital_words", "log_lines", "repeated_lines", "mean_line", "ended_lines",
)


class Trees(NamedTuple):
    """All trees as arrays: split feature and threshold of each inner node, value of each leaf.

    Trees are complete: node n has the children 2n+1 and 2n+2. A node that is not split has an
    infinite threshold.
    """

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of each row; all rows walk down a tree together."""
        total, every = np.full(len(rows), self.base), np.arange(len(rows))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[every, feature[node]] > threshold[node])
            total += value[node - inner]
        return total


def statistics(text: str | None) -> list[float]:
    """Statistics of a whole text; zeros for an empty one."""
    text = text or ""
    raw = text.encode()
    if not raw:
        return [0.0] * len(STATISTICS)
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    words = raw.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in (y.strip() for y in raw.split(b"\n")) if x]
    symbols = int(bytes_[list(b"#*$%&|<>")].sum())
    digits, upper, lower = int(bytes_[48:58].sum()), int(bytes_[65:91].sum()), int(bytes_[97:123].sum())
    marks, space = int(bytes_[list(b".,;:?'\"()-")].sum()), int(bytes_[[9, 10, 11, 12, 13, 32]].sum())
    return [
        math.log1p(len(text)), math.log1p(len(words)), sum(map(len, words)) / n, math.log1p(max(map(len, words), default=0)),
        upper / size, lower / size, digits / size, symbols / size, marks / size, int(bytes_[33]) / size,
        int(bytes_[128:].sum()) / size, space / size, len(counts) / n, max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, sum(w[:1].isupper() for w in words) / n, math.log1p(len(lines)),
        1 - len(set(lines)) / max(1, len(lines)), math.log1p(sum(map(len, lines)) / max(1, len(lines))),
        sum(x[-1:] in b".!?" for x in lines) / max(1, len(lines)),
    ]


def fit(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Trees that lower the logistic loss, each node split at the best edge of its histograms."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    edges = [np.unique(np.quantile(rows[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(e, rows[:, k], side="left") for k, e in enumerate(edges)], axis=1)
    share = np.clip(labels.mean(), 1e-4, 1 - 1e-4)
    base = math.log(share / (1 - share))
    margin = np.full(len(rows), base)
    features, thresholds, values = [], [], []
    offsets = np.arange(rows.shape[1]) * BINS
    for _ in range(TREES):
        p = sigmoid(margin)
        first, second = p - labels, p * (1 - p)
        node = np.zeros(len(rows), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for depth in range(DEPTH):
            for at in range(2**depth - 1, 2 ** (depth + 1) - 1):
                own = np.flatnonzero(node == at)
                if not len(own):
                    continue
                cells = (binned[own] + offsets).ravel()
                shape = (rows.shape[1], BINS)
                g = np.bincount(cells, np.repeat(first[own], rows.shape[1]), minlength=shape[0] * BINS).reshape(shape).cumsum(1)
                h = np.bincount(cells, np.repeat(second[own], rows.shape[1]), minlength=shape[0] * BINS).reshape(shape).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + LEAF_PENALTY) + (g_all - g) ** 2 / (h_all - h + LEAF_PENALTY) - g_all**2 / (h_all + LEAF_PENALTY)
                gain[(h < LEAST_CHILD) | (h_all - h < LEAST_CHILD)] = 0
                k, edge = np.unravel_index(np.argmax(gain), shape)
                if gain[k, edge] > 1e-9 and edge < len(edges[k]):
                    feature[at], threshold[at] = k, edges[k][edge]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > threshold[node])
        leaf = node - inner
        g, h = np.bincount(leaf, first, leaves), np.bincount(leaf, second, leaves)
        value = -RATE * g / (h + LEAF_PENALTY)
        margin += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(values), base)


def train(docs: DataFrame, labels: DataFrame, label: str, training: Column, text: str = "text", key: str = "doc_id") -> Trees:
    """Trees fitted on labelled texts for which ``training`` is true.

    Up to ``TEXTS`` of them, chosen by a hash of the key; their statistics, not their texts,
    reach the driver. Several labels of a key count by their mean; null labels and keys are left
    out. Without labels of both classes the trees are empty and their base is the share of 1
    (0.5 without labels).
    """
    sample = sampled(mean_labels(labels, label, training, key), TEXTS, key)
    texts = docs.select(key, F.col(text).alias("_text")).join(F.broadcast(sample), key).select("_text", "label")

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"label": frame["label"], "statistics": [statistics(x) for x in frame["_text"]]})

    found = texts.mapInPandas(rows, "label int, statistics array<double>").collect()
    labelled = np.array([r["label"] for r in found])
    if len(set(labelled.tolist())) < 2:
        share = (labelled.sum() + 0.5) / (len(labelled) + 1)
        return Trees(np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)), math.log(share / (1 - share)))
    return fit(np.array([r["statistics"] for r in found]), labelled)


def score(docs: DataFrame, trees: Trees, text: str = "text", out: str = "score") -> DataFrame:
    """All rows and columns with the probability of label 1.

    The whole text counts; a null or empty text has statistics of zero. Repeated rows get the
    same score. A column that is already called ``out`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)        # of fixed size

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            rows = np.array([statistics(x) for x in part]).reshape(len(part), len(STATISTICS))
            yield pd.Series(sigmoid(shared.value.margin(rows)))

    return docs.drop(out).withColumn(out, scores(F.col(text)))

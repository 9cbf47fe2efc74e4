"""Toxicity by compression distance between two zstandard dictionaries."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.fitting import logistic, mean_labels, sampled, sigmoid

#: Labelled texts of each class from which dictionaries are made, and texts for calibration.
TEXTS = 3_000
CALIBRATION = 8_000
#: Passages of each class that reach the driver, and their length in words.
PASSAGES = 120_000
PASSAGE_WORDS = 4
#: Bytes of the dictionary of ordinary text; that of toxic text has all words that tell it apart.
ORDINARY_BYTES = 112_640
#: Lengths of character sequences looked at, and how many times more often a telling one must be toxic.
SEQUENCES = range(4, 11)
PURITY = 20
#: Chance at which an innocent sequence may pass for a telling one.
CHANCE = 1e-8
#: Stands before each window and each entry of the toxic dictionary, so that whole words match as one.
FRAME = b"\n\n\n"
#: Both dictionaries end with this, and so does each window: zstandard does not look for matches in its last bytes.
TAIL = b" \n0123456789abcdef0123456789abcdef"
#: Thresholds, calibrated together: bytes saved, and bytes above those of a perfect match.
MOST_SAVED, MOST_ABOVE = 6, 4
CELLS = 1 + MOST_SAVED * (MOST_ABOVE + 1)
#: Windows whose distance a task remembers.
REMEMBERED = 400_000


class Model(NamedTuple):
    """Contents of the two dictionaries and the calibrated weights; ``weights`` is None without a model."""

    ordinary: bytes
    toxic: bytes
    weights: list[float] | None
    prior: float


#: A word is a run of these in lower-case UTF-8: digits, letters, all beyond ASCII.
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return WORDS.findall((text or "").lower().encode())


class Distances(dict):
    """Window to the cell of its compressed lengths: what the toxic dictionary saves over the
    ordinary one, and how far it is from a perfect match. Cell 0 is for windows that save nothing."""

    def __init__(self, model: Model):
        super().__init__()
        self.ordinary = self.compressor(model.ordinary + TAIL)
        self.toxic = self.compressor(model.ordinary + model.toxic + TAIL)
        last = model.toxic.split()[-1:] or [b"-"]
        self.perfect = len(self.toxic(FRAME + last[0] + TAIL))

    @staticmethod
    def compressor(content: bytes):
        """Raw content: without entropy tables a literal costs a whole byte, so lengths can be compared."""
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=3)
        return zstandard.ZstdCompressor(
            level=3, dict_data=held, write_content_size=False, write_dict_id=False, write_checksum=False,
        ).compress

    def __missing__(self, word: bytes) -> int:
        window = FRAME + word + TAIL
        length = len(self.toxic(window))
        saved = len(self.ordinary(window)) - length
        above = min(max(length - self.perfect, 0), MOST_ABOVE)
        cell = 0 if saved <= 0 else above * MOST_SAVED + min(saved, MOST_SAVED)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = cell
        return cell


def features(text: str | None, distances: Distances) -> np.ndarray:
    """Of all windows of a whole text: how many fall into each cell, and how many there are."""
    words = words_of(text)
    cells = np.fromiter(map(distances.__getitem__, words), np.int64, len(words))
    counts = np.bincount(cells, minlength=CELLS)
    counts[0] = len(words)
    return np.append(np.log1p(counts), 1.0)


def train(docs: DataFrame, labels: DataFrame, label: str, training: Column, text: str = "text", key: str = "doc_id") -> Model:
    """Dictionaries and calibration from labelled texts for which ``training`` is true.

    Bounded samples are used, chosen by a hash of the key: up to ``TEXTS`` texts of each class
    for the dictionaries and ``CALIBRATION`` other ones for the weights. Several labels of a key
    count by their mean; null labels and keys are left out. Without texts of both classes there
    is no model, and the share of toxic labels is every score.

    The dictionary of ordinary text is made by zstandard's trainer. Toxic text is mostly
    ordinary words, so the toxic dictionary is that same content followed by what tells toxic
    text apart: the words with a character sequence that stands in toxic passages far more often
    than chance allows, the most frequent ones last.
    """
    known = mean_labels(labels, label, training, key)
    fold = F.pmod(F.crc32(F.col(key).cast("string")) / 5, F.lit(4)).cast("int") == 0
    ordinary, toxic = (
        _passages(docs, sampled(known.where(~fold & (F.col("label") == value)), TEXTS, key), text, key)
        for value in (0, 1)
    )
    share = known.agg(F.avg("label")).first()[0] or 0.0
    if not ordinary or not toxic:
        return Model(b"", b"", None, float(share))
    try:
        common = zstandard.train_dictionary(ORDINARY_BYTES, ordinary).as_bytes()
    except zstandard.ZstdError:     # too little text to train on: the text itself
        common = b"".join(ordinary)[-ORDINARY_BYTES:]
    model = Model(common, telling(toxic, ordinary), [], float(share))
    rows = _features(docs, sampled(known.where(fold), CALIBRATION, key), model, text, key).collect()
    if len({r["label"] for r in rows}) < 2:
        return model._replace(weights=None)
    weights = logistic(np.array([r["features"] for r in rows]), np.array([r["label"] for r in rows]))
    return model._replace(weights=weights.tolist())


def telling(toxic: list[bytes], ordinary: list[bytes]) -> bytes:
    """The content that sets toxic passages apart, out of distinct passages of each class."""
    inside = Counter(w for p in toxic for w in set(p.split()))
    outside = Counter(w for p in ordinary for w in set(p.split()))
    scale = len(toxic) / len(ordinary)
    least = math.log(CHANCE) / math.log(len(toxic) / (len(toxic) + len(ordinary)))

    def sequences(word: bytes) -> set[bytes]:
        framed = b" " + word + b" "
        return {framed[k:k + n] for n in SEQUENCES for k in range(len(framed) - n + 1)}

    found: Counter = Counter()
    for word, n in inside.items():
        for sequence in sequences(word):
            found[sequence] += n
    found = Counter({s: n for s, n in found.items() if n >= least})
    common: Counter = Counter()
    for word, n in outside.items():
        for sequence in sequences(word):
            if sequence in found:
                common[sequence] += n
    marks = {s for s, n in found.items() if n >= PURITY * common[s] * scale}
    words = Counter({
        w: n for w, n in inside.items()
        if n >= PURITY * outside[w] * scale and any(n >= 3 or s[:1] == b" " for s in sequences(w) & marks)
    })
    ranked = sorted(words, key=lambda w: (-words[w], w))
    return b"".join(FRAME + w + b" " for w in reversed(ranked))


def _passages(docs: DataFrame, sample: DataFrame, text: str, key: str) -> list[bytes]:
    """Distinct passages of the sampled texts; up to ``PASSAGES``, by hash."""

    def passages(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for content in frame["_text"]:
                words = words_of(content)
                made += [b" " + b" ".join(words[k:k + PASSAGE_WORDS]) for k in range(0, len(words), PASSAGE_WORDS)]
            yield pd.DataFrame({"passage": made})

    texts = docs.select(key, F.col(text).alias("_text")).join(F.broadcast(sample), key).select("_text")
    found = texts.mapInPandas(passages, "passage binary").distinct()
    return [bytes(r["passage"]) for r in found.orderBy(F.xxhash64("passage"), "passage").limit(PASSAGES).collect()]


def _features(docs: DataFrame, sample: DataFrame, model: Model, text: str, key: str) -> DataFrame:
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        distances = Distances(model)
        for frame in frames:
            yield pd.DataFrame({"label": frame["label"], "features": [features(x, distances).tolist() for x in frame["_text"]]})

    texts = docs.select(key, F.col(text).alias("_text")).join(F.broadcast(sample), key).select("_text", "label")
    return texts.mapInPandas(rows, "label int, features array<double>")


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All rows and columns with the probability of being toxic.

    The whole text counts. A null or empty text has no windows and gets what the weights make of
    that; repeated rows get the same score. A column that is already called ``out`` is replaced.
    """
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    if model.weights is None:
        return docs.withColumn(out, F.lit(model.prior))
    shared = docs.sparkSession.sparkContext.broadcast(model)        # of fixed size

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        distances, weights = Distances(shared.value), np.array(shared.value.weights)
        for part in texts:
            rows = np.array([features(x, distances) for x in part]).reshape(len(part), len(weights))
            yield pd.Series(sigmoid(rows @ weights))

    return docs.withColumn(out, scores(F.col(text))).select(*schema.names)

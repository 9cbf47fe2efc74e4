"""Language-model scores: the likelihood of a text over all its subword segmentations."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.common import cut, lower_ascii, pack, pack_codes, unpack, unpack_codes
from tallyweave.llm.pieces import Lattice, Vocabulary, expected, marginals
from tallyweave.llm.wordblocks import assembled, coded, words_of

#: Rounds of fitting the vocabulary's scores to the training words.
ROUNDS = 2
#: Weight of the vocabulary's own scores, as a number of words.
PRIOR = 1000.0
#: Shares tried for the arc that spans a whole known word.
SHARES = (0.0, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98)


def score(docs: DataFrame, training: Column, vocabulary: Vocabulary, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and the scores of every whole text.

    ``training`` is true for the rows to learn from (null: not). Words are runs without ASCII
    white space, A-Z in lower case; every text ends with one end token. A word's lattice has the
    pieces of ``vocabulary``, and one arc for the whole word if training texts hold it. A
    log-space forward recursion sums all ways through. Scores start as those of the vocabulary
    and are fitted to the training words (expected piece counts); the share of the whole-word
    arc is the one that predicts training words best when each occurrence is left out in turn.

    ``n_tokens`` words and end, ``n_known`` those seen in training, ``train_tokens`` all tokens
    in training, ``base_score`` the log10 probability by add-one word counts, ``score`` that of
    the lattice model. A null, empty or blank text is the end token alone. Without training rows
    counts are zero and the vocabulary's own scores decide. Repeated rows are scored alike;
    further columns of ``docs`` play no part.
    """
    spark = docs.sparkSession
    marked = docs.select(*keep, F.col(text).alias("_scored"), F.coalesce(training, F.lit(False)).alias("_training"))
    blocks = coded(marked, "_scored", keep, lambda: lambda x: x.encode().translate(lower_ascii()).split(), "_training", store=True)
    words = cut(words_of(blocks).groupBy("owner").applyInPandas(
        _merged, "owner int, words binary, counts binary, total long, seen long",
    ))
    total = words.agg(F.sum("total"), F.sum("seen")).first()
    texts = docs.where(F.coalesce(training, F.lit(False))).count()
    n_words = total[0] or 0
    tokens, distinct = n_words + texts, (total[1] or 0) + (texts > 0)

    shared = spark.sparkContext.broadcast(vocabulary)       # a vocabulary, of fixed size
    scores = vocabulary.scores
    for _ in range(ROUNDS if n_words else 0):
        scores = _fitted(words, shared, vocabulary, scores)

    fitted = spark.sparkContext.broadcast(scores)
    valued = cut(words.mapInPandas(
        _values(shared, fitted, n_words), "owner int, words binary, counts binary, logs binary, trials array<double>",
    ))
    trials = valued.agg(*[F.sum(F.col("trials")[k]) for k in range(len(SHARES))]).first()
    share = SHARES[max(range(len(SHARES)), key=lambda k: trials[k])] if n_words else 0.0

    answers = words_of(blocks).groupBy("owner").cogroup(valued.groupBy("owner")).applyInPandas(
        _answers(share, n_words), "block long, owner int, answers binary",
    )
    return assembled(
        blocks, answers, _finish(texts, tokens, distinct), [
            T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ],
    )


def _merged(frame: pd.DataFrame) -> pd.DataFrame:
    """An owner's distinct words and how often each stands in training texts."""
    totals: defaultdict = defaultdict(int)
    for own, sizes in zip(frame["payload"], frame["sizes"]):
        for word, n in zip(unpack(own), unpack_codes(sizes).tolist()):
            totals[word] += n
    ordered = sorted(totals)
    counts = np.array([totals[w] for w in ordered], "<i8")
    return pd.DataFrame({
        "owner": [frame["owner"].iloc[0]], "words": [pack(ordered)], "counts": [pack([counts.tobytes()])],
        "total": [int(counts.sum())], "seen": [int((counts > 0).sum())],
    })


def _counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(unpack(packed)[0], "<i8")


def _fitted(words: DataFrame, shared, vocabulary: Vocabulary, scores: list[float]) -> list[float]:
    """Scores from the expected uses of each piece; a row per piece reaches the driver."""
    current = words.sparkSession.sparkContext.broadcast(scores)

    def uses(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice, sums = Lattice(shared.value, current.value), np.zeros(len(current.value))
        for frame in frames:
            for own, packed in zip(frame["words"], frame["counts"]):
                counts = _counts(packed)
                known = [(w, n) for w, n in zip(unpack(own), counts.tolist()) if n]
                sums += expected([x[0] for x in known], [x[1] for x in known], lattice)
        used = np.flatnonzero(sums)
        yield pd.DataFrame({"piece": used, "uses": sums[used]})

    found = words.mapInPandas(uses, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
    weights = [PRIOR * math.exp(s) for s in vocabulary.scores]
    for row in found.collect():
        weights[row["piece"]] += row["uses"]
    total = math.log(math.fsum(weights))
    return [math.log(w) - total for w in weights]


def _values(shared, fitted, n_words: int):
    """Log probabilities of an owner's words by pieces, and what each share would give."""

    def values(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(shared.value, fitted.value)
        for frame in frames:
            logs, trials = [], []
            for own, packed in zip(frame["words"], frame["counts"]):
                by_piece, counts = np.array(marginals(unpack(own), lattice)), _counts(packed)
                logs.append(pack([by_piece.astype("<f8").tobytes()]))
                seen = counts > 0
                n, rest = counts[seen], (counts[seen] - 1) / max(1, n_words - 1)
                trials.append([
                    float((n * np.logaddexp(_log(share * rest), _log(1 - share) + by_piece[seen])).sum())
                    for share in SHARES
                ])
            yield pd.DataFrame({"owner": frame["owner"], "words": frame["words"], "counts": frame["counts"], "logs": logs, "trials": trials})

    return values


def _log(x):
    with np.errstate(divide="ignore"):
        return np.log(x)


def _answers(share: float, n_words: int):
    """Count and log probability of each word of each block."""

    def answers(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame({"block": [], "owner": [], "answers": []})
        counts = _counts(right["counts"].iloc[0])
        by_piece = np.frombuffer(unpack(right["logs"].iloc[0])[0], "<f8")
        value = np.logaddexp(_log(share * counts / max(1, n_words)), _log(1 - share) + by_piece)
        items = np.empty((len(counts), 2), "<f8")
        items[:, 0], items[:, 1] = counts, value
        place = {w: k for k, w in enumerate(unpack(right["words"].iloc[0]))}
        made = []
        for own in left["payload"]:
            chosen = items[[place[w] for w in unpack(own)]]
            made.append(pack([chosen.tobytes()]))
        return pd.DataFrame({"block": left["block"], "owner": left["owner"], "answers": made})

    return answers


def _finish(texts: int, tokens: int, distinct: int):
    def finish(codes, sizes, lengths, data):
        items = np.frombuffer(data, "<f8").reshape(-1, 2)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        stop = (texts + 1) / (tokens + 2)       # the next token is the end
        floor = math.log10(tokens + distinct + 1)

        def per_document(values, dtype=np.float64):
            return np.add.reduceat(np.append(values[codes], 0).astype(dtype), ends[:-1]) * (sizes > 0) if len(sizes) else np.zeros(0, dtype)

        base = per_document(np.log10(items[:, 0] + 1) - floor) + math.log10(texts + 1) - floor
        model = (per_document(items[:, 1]) + sizes * math.log1p(-stop) + math.log(stop)) / math.log(10)
        known = per_document(items[:, 0] > 0, np.int64) + (texts > 0)
        return [
            pa.array(sizes + 1, pa.int64()), pa.array(known, pa.int64()),
            pa.array(np.full(len(sizes), tokens), pa.int64()), pa.array(base), pa.array(model),
        ]

    return finish

"""Quality rules per document, and verdicts on hosts from shrunken failure rates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import cut

#: Words of a window of which a repeat counts.
WINDOW = 8
#: Base rules: fewest words, and percent of words in repeated windows.
LEAST_WORDS = 20
MOST_REPEATED = 30
#: Further rules: symbols per hundred words, repeated lines per hundred lines.
MOST_SYMBOLS = 10
MOST_EQUAL_LINES = 30
#: A host falls when its shrunken rate of failing documents is above this.
HOST_RATE = 0.5
#: Bounds of the prior's weight, in documents.
PRIOR_WEIGHTS = (2.0, 1e6)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
SPACE = b" \t\n\x0b\x0c\r"


def repeated_words(words: list[bytes]) -> int:
    """Words in windows that stand twice or more in the text, by joining equal neighbours thrice."""
    if len(words) <= WINDOW:
        return 0
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    step = 1
    while step < WINDOW:
        pairs = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        ids = np.unique(pairs, return_inverse=True)[1]
        step *= 2
    often = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def counted(text: str | None) -> tuple[int, ...]:
    """The ``COUNTS`` of a whole text; zeros for none."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    spaces, symbols = sum(raw.count(c) for c in SPACE), sum(raw.count(c) for c in b"#*$%&|<>")
    return len(words), len(text) - spaces, symbols, len(lines), len(lines) - len(set(lines)), repeated_words(words)


def judged(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """One row per document: its counts, its own failures, its host's rate and the verdict.

    A document fails when it breaks a base rule or one on symbols and repeated lines. Failures
    are summed by host; the rate of a host is drawn towards that of all hosts by a beta prior
    whose mean and weight come from the hosts themselves (method of moments). ``kept`` is false
    for documents that fail, and for all documents of a host whose rate is above ``HOST_RATE``.

    A null or empty text has no words and fails. A document without a host is judged alone.
    Repeated rows count as often as they stand there. Further columns play no part.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = pd.DataFrame([counted(x) for x in frame.pop("_text")], columns=list(COUNTS))
            yield pd.concat([frame.reset_index(drop=True), rows], axis=1)

    chosen = docs.select(F.col(key).cast("string").alias("_key"), F.col(host).alias("_host"), F.col(text).alias("_text"))
    kind = docs.schema[host].dataType.simpleString()
    found = chosen.mapInPandas(count, f"_key string, _host {kind}, " + ", ".join(f"{c} long" for c in COUNTS))
    words = F.col("n_words")
    base = (words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * words)
    more = (100 * F.col("n_symbols") > MOST_SYMBOLS * words) | (100 * F.col("n_dup_lines") > MOST_EQUAL_LINES * F.col("n_lines"))
    counts = cut(found.withColumn("base_failed", base).withColumn("rule_failed", base | more))
    # Stored, so that the join below can split a hot host or broadcast few hosts.
    hosts = cut(host_rates(counts.where(F.col("_host").isNotNull()), "_host", "rule_failed"))
    verdict = ~F.col("rule_failed") & (F.coalesce(F.col("host_rate"), F.lit(0.0)) <= HOST_RATE)
    return counts.join(hosts, "_host", "left").select(
        F.col("_key").cast(docs.schema[key].dataType).alias(key), F.col("_host").alias(host), *COUNTS,
        "base_failed", "rule_failed", F.round("host_rate", 6).alias("host_rate"), verdict.alias("kept"),
    )


def host_rates(counts: DataFrame, host: str, failed: str) -> DataFrame:
    """The failure rate of each host, shrunk by an empirical beta prior.

    With m and v the mean and variance of the raw rates over hosts and k the mean of 1 / n, the
    spread between hosts beyond chance is v - m(1-m)k, and the weight of the prior is
    (m(1-m) - v) over that, kept between ``PRIOR_WEIGHTS``; without such spread it is the largest.
    """
    hosts = counts.groupBy(host).agg(F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("failures"))
    rate, least, most = F.col("failures") / F.col("n"), *map(F.lit, PRIOR_WEIGHTS)
    prior = hosts.agg(F.avg(rate).alias("m"), F.coalesce(F.var_samp(rate), F.lit(0.0)).alias("v"), F.avg(1 / F.col("n")).alias("k"))
    chance = F.col("m") * (1 - F.col("m"))
    between = F.col("v") - chance * F.col("k")
    weight = F.when(between > 0, F.least(most, F.greatest(least, (chance - F.col("v")) / between))).otherwise(most)
    return hosts.join(F.broadcast(prior.withColumn("weight", weight))).select(      # one row
        host, ((F.col("failures") + F.col("m") * F.col("weight")) / (F.col("n") + F.col("weight"))).alias("host_rate"),
    )

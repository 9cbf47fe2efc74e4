"""The corpus pipeline: stages from documents to token ids, each one an operator of ``tallyweave.llm``.

A stage takes what its predecessor kept; all but the last return the columns of ``documents``.
A driver that stores the stages writes each result as Parquet and hands it to the next; ``run``
chains them.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import byte_bpe, decontaminate, jaccard_join, line_dedup, toxicity
from tallyweave.llm.common import cut, remainder, table
from tallyweave.llm.queries import RANKS

#: A document as toxic as this goes.
REJECTED = 0.5
#: Documents that Spark hands a Python worker at a time. Both hold a batch several times over, outside the heap.
AT_ONCE = 1_000
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(stage):
    """The stage in a session with batches of ``AT_ONCE`` rows; that stays, as the caller runs the result."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        if not 0 < int(spark.conf.get(BATCH)) <= AT_ONCE:
            spark.conf.set(BATCH, str(AT_ONCE))
        return stage(spark, docs, folder)

    return run


@in_small_batches
def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose text is not scored as toxic; learnt from ``labels``, as in op1."""
    learnt = remainder(F.col("doc_id"), 5) != 0
    model = toxicity.train(docs, table(spark, folder, "labels"), "toxic", learnt)
    scored = toxicity.score(docs, model, out="_toxic")
    return scored.where(F.col("_toxic") < REJECTED).select(*docs.columns)


def without_boilerplate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without lines of any length that many sources share; ``n_chars`` follows the text."""
    cleaned = line_dedup.without_boilerplate(docs, least_words=1)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", length).select(*docs.columns)


@in_small_batches
def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies, that of the lowest id."""
    return jaccard_join.deduplicated(docs).select(*docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.decontaminated(docs, table(spark, folder, "benchmark")).select(*docs.columns)


@in_small_batches
def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of what is left: their number and digest, and that of the bytes they decode to."""
    return byte_bpe.digests(docs, byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN, byte_bpe.RUNS)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_boilerplate),
    ("jaccard_join", without_near_copies),
    ("decontamination", without_leaks),
    ("byte_bpe", encoded),
]

#: SQL can neither train a classifier nor merge byte pairs; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each on a checkpoint of the one before."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, folder)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs

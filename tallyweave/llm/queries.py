"""Registered queries of this subpackage and, where SQL can express them, the SQL that checks them."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import byte_bpe, collocations, decontaminate, jaccard_join, line_dedup, lm_score, merkle, packing, quality_rules, quality_trees, sql, token_counts, toxicity, training_order
from tallyweave.llm.common import remainder, table
from tallyweave.llm.pieces import read_vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.digests(table(spark, folder, "documents"), byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN, byte_bpe.RUNS)


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), read_vocabulary(PIECES), ["doc_id"])


@query
def op7_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", remainder(F.col("doc_id"), 7) == 2)
    return lm_score.score(docs, ~F.col("held_out"), read_vocabulary(PIECES), ["doc_id", "held_out"])


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, learnt = table(spark, folder, "documents"), remainder(F.col("doc_id"), 5) != 0
    model = toxicity.train(docs, table(spark, folder, "labels"), "toxic", learnt)
    scored = toxicity.score(docs.select("doc_id", "text", (~learnt).alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, learnt = table(spark, folder, "documents"), remainder(F.col("doc_id"), 5) != 0
    trees = quality_trees.train(docs, table(spark, folder, "labels"), "quality", learnt)
    scored = quality_trees.score(docs.select("doc_id", "text", (~learnt).alias("held_out")), trees)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents"))


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return line_dedup.without_boilerplate(docs, removed="n_removed").select("doc_id", "n_removed", "text")


@query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("_key").alias("doc_id"), F.col("_item").alias("item_id"), "n_shared", "n_item")


SQL |= {"op10_quality_rules": sql.QUALITY_RULES, "op5_line_dedup": sql.LINE_DEDUP, "op3_decontamination": sql.DECONTAMINATION}


@query
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard_join.linked(table(spark, folder, "documents"))
    return found.select(
        F.col("_key").alias("doc_id"), F.col("first._key").alias("class_id"), "n_links", F.col("leader._key").alias("group_id"),
    )


#: Key of the training order.
ORDER_KEY = 20260101


@query
def op9_training_order(spark: SparkSession, folder: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(RANKS)
    encoder = byte_bpe.encoder(spark, ranks, public_tokenizers.PATTERN)
    found = training_order.sequences(table(spark, folder, "documents"), encoder, separator=max(ranks.values()) + 1)
    return training_order.shards(found, ORDER_KEY).withColumn("sha256", F.sha2("payload", 256))


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.when(remainder(F.col("doc_id"), 5) == 0, F.translate("text", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("text"))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tree = merkle.manifest(table(spark, folder, "documents"), "doc_id", "source", columns, {"text": tampered})
    return merkle.folded(tree).withColumnRenamed("_key", "doc_id")


SQL |= {"op11_merkle_manifest": sql.MERKLE}


#: Tokens of a sequence, and the id that ends a document.
CAPACITY, END = 1024, 2


@query
def op13_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    encode = packing.encoder(spark, *map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    cut = packing.pieces(table(spark, folder, "documents"), encode, END, CAPACITY, ids=False)
    return packing.packed(cut, CAPACITY)


@query
def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


SQL |= {"op12_phrase_collocations": sql.COLLOCATIONS}

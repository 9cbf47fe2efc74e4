"""Short test items inside long documents: MinHash containment search, verified exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import cut
from tallyweave.llm.rows import IDENTITY, bound, join_rows, wrapped

#: Words of a shingle, and the percentage of an item's shingles that a document must hold.
SHINGLE = 5
CONTAINED = 80
#: Sketch values up to which they are broadcast; sixteen bytes each.
BROADCAST_VALUES = 1_000_000


def shingles(text: Column) -> Column:
    """Runs of five words of a text: lower case, letters and digits only. Null below five words."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")
    return bound(words, lambda own: F.when(F.size(own) >= SHINGLE, F.transform(
        F.sequence(F.lit(1), F.size(own) - (SHINGLE - 1)), lambda k: F.array_join(F.slice(own, k, SHINGLE), " "),
    )))


def sketches(items: DataFrame) -> DataFrame:
    """MinHash values of each item, as many as its size partition needs.

    A document that holds 80 % of an item's n shingles misses at most ``n - ceil(0.8 n)`` of
    them, so it holds one at least of any ``n - ceil(0.8 n) + 1``. The smallest hashes serve as
    these: no item is missed, whatever the size of the document. Items are partitioned by the
    power of two of their size; a partition takes as many values as its largest item needs.
    """
    sized = items.withColumn("_part", F.floor(F.log2("_n")))
    needed = F.col("_n") - F.ceil(F.col("_n") * CONTAINED / 100) + 1
    parts = sized.groupBy("_part").agg(F.max(needed).cast("int").alias("_values"))
    smallest = F.array_sort(F.array_distinct(F.transform("_shingles", lambda s: F.xxhash64(s))))
    return sized.join(parts, "_part").select("_item", F.explode(F.slice(smallest, 1, F.col("_values"))).alias("_hash"))


def contained(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text",
) -> DataFrame:
    """Pairs of documents and items of which they hold 80 % of the distinct shingles or more.

    Columns ``_key``, ``_id``, ``_id2`` (the row), ``_item``, ``n_shared``, ``n_item``. Texts of
    fewer than five words, null and empty ones have no shingles and are in no pair. Rows that
    repeat each other are one; items with the same text and different ids are several.
    """
    tests = cut(
        items.select(F.col(item).alias("_item"), F.array_distinct(shingles(F.col(text))).alias("_shingles"))
        .where(F.col("_shingles").isNotNull()).distinct().withColumn("_n", F.size("_shingles"))
    )
    marks = cut(sketches(tests))
    if marks.count() <= BROADCAST_VALUES:
        marks = F.broadcast(marks)
    rows = wrapped(docs, key, text).drop("_row")
    hashes = rows.select(*IDENTITY, F.explode(F.transform(shingles(F.col("_text")), lambda s: F.xxhash64(s))).alias("_hash"))
    candidates = cut(hashes.join(marks, "_hash").select(*IDENTITY, "_item").distinct())
    pairs = join_rows(rows, candidates, "inner").select(
        *IDENTITY, F.col("_item").alias("_found"), shingles(F.col("_text")).alias("_held"),
    )
    shared = F.size(F.array_intersect("_shingles", "_held"))
    verified = pairs.join(tests, F.col("_found").eqNullSafe(F.col("_item"))).select(
        *IDENTITY, "_item", shared.cast("long").alias("n_shared"), F.col("_n").cast("long").alias("n_item"),
    )
    return verified.where(F.col("n_shared") * 100 >= F.col("n_item") * CONTAINED).distinct()


def decontaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    rows = wrapped(docs, key, text)
    found = contained(docs, items, key, item, text).select(*IDENTITY).distinct()
    return join_rows(rows, found, "left_anti").select("_row.*")

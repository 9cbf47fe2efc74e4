"""Packing of documents into token sequences, best fit decreasing.

Only the lengths decide a packing, and there are no more lengths than a sequence holds. So the
plan is made from the number of pieces of each length: lengths go from long to short, and each
goes into the open bins with the least room that still takes it, found by a segment tree over
the room left. Bins alike are taken as one run, pieces alike as one run; a plan is a list of
such runs, whatever the number of documents. Spark numbers the pieces of each length and joins
them to the runs.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from tallyweave.llm.byte_bpe import read_ranks
from tallyweave.llm.running import laid

Encode = Callable[[], Callable[[str], np.ndarray]]


class Texts:
    """Ids of texts by a tokenizer file.

    A rank file of the same vocabulary gives the same ids in less than half the time, so it is
    used where nothing can differ: for texts of characters that every version of Unicode
    classifies alike, without the strings of special tokens and very long runs of white space.
    Other texts go through the tokenizer itself; a test holds both to each other.
    """

    def __init__(self, tokenizer: Tokenizer, ranks: tiktoken.Encoding):
        self.tokenizer, self.ranks = tokenizer, ranks
        special = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
        self.apart = re.compile("|".join([*special, ODD, r"\s{1000}"]))

    def __call__(self, text: str) -> np.ndarray:
        if self.apart.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.ranks.encode_ordinary(text), "<u4")


#: Characters outside Latin, Greek and Cyrillic, general punctuation, currencies, kana and Chinese.
ODD = "[^\x00-\u052f\u2010-\u2027\u20a0-\u20bf\u3000-\u30ff\u4e00-\u9fa5]"


def encoder(spark: SparkSession, path: str, ranks_path: str, pattern: str) -> Encode:
    """What a task calls to get a function from a text to its ids; ``path`` decides, see ``Texts``."""
    with open(path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast((file.read(), read_ranks(ranks_path)))      # vocabularies, of fixed size

    def made():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        content, ranks = shared.value
        return Texts(Tokenizer.from_str(content), tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))

    return made


def pieces(docs: DataFrame, encode: Encode, end: int, capacity: int, key: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """Rows ``key``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.

    A document is its ids and then ``end``, so a null or empty text is the end alone. Documents
    longer than ``capacity`` are cut; all pieces but the first are full. Repeated rows and rows
    with a null key are documents of their own; further columns of ``docs`` play no part.
    """
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        *[T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids,
    ])
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encode()
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                rows: list[list] = [[], [], [], [], [], []]
                for at, text in enumerate(part.column(1)):
                    found = np.append(encoding(text.as_py()), np.uint32(end)).astype("<u4")
                    bounds = [0, *range(len(found) % capacity or capacity, len(found) + 1, capacity)]
                    for number, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        for column, value in zip(rows, (at, number, a, b - a, zlib.crc32(found[a:b].tobytes()), found[a:b].astype(np.int32))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(rows[0])).cast(arrow.field(0).type),
                    *(pa.array(x, f.type) for x, f in zip(rows[1:], list(arrow)[1:])),
                ], schema=arrow)

    return docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text")).mapInArrow(cut, schema)


class Room:
    """A segment tree over the room left in bins: which is the least that still takes a piece?"""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)

    def mark(self, room: int, there: bool) -> None:
        at = room + self.leaves
        self.any[at] = there
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length`` that some bin has."""
        at = length + self.leaves
        while not self.any[at]:
            while at & 1:               # nothing right of here below this node: go up
                at //= 2
            if at == 0:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        return at - self.leaves


class Run(NamedTuple):
    """Pieces from ``first`` on of a length go to bins from ``sequence`` on, ``times`` to a bin, from ``offset`` on."""

    length: int
    first: int
    sequence: int
    offset: int
    times: int


def plan(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best fit decreasing for so many pieces of each length.

    The tightest bin is still the tightest after it took a piece and has room for one more, so
    a bin takes as many pieces of a length as it can before the next one does.
    """
    room, bins, runs, opened = Room(capacity), defaultdict(list), [], 0

    def put(left: int, first: int, many: int) -> None:
        if many and left:
            bins[left].append((first, many))
            room.mark(left, True)

    for length in sorted(counts, reverse=True):
        done, count = 0, counts[length]
        while done < count:
            left = room.tightest(length)
            if left is None:
                left, many = capacity, -(-(count - done) // (capacity // length))
                first, opened = opened, opened + many
            else:
                first, many = bins[left].pop()
                if not bins[left]:
                    room.mark(left, False)
            times = left // length
            full = min(many, (count - done) // times)
            rest = min(count - done - full * times, times) if full < many else 0
            runs.append(Run(length, done, first, capacity - left, times))
            put(left - times * length, first, full)
            if rest:
                put(left - rest * length, first + full, 1)
            put(left, first + full + bool(rest), many - full - bool(rest))
            done += full * times + rest
    return runs


def packed(cut: DataFrame, capacity: int, key: str = "doc_id") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces.

    Sequences hold ``capacity`` tokens at most, their pieces one after the other from 0 on. A
    length of any number of pieces is numbered partition by partition. Pieces alike in key and
    content may change places. An empty table needs no sequence.
    """
    held = laid(cut.withColumn("_part", F.spark_partition_id()), "pieces")
    sums = laid(held.groupBy("length", "_part").agg(F.count("*").alias("_n")), "lengths")
    totals = sums.groupBy("length").agg(F.sum("_n").alias("n")).collect()       # a row per length, so ``capacity`` at most
    runs: dict[int, list[Run]] = defaultdict(list)
    for run in plan({r["length"]: r["n"] for r in totals}, capacity):
        runs[run.length].append(run)
    # Their number follows that of lengths and rooms, not that of documents.
    shared = cut.sparkSession.sparkContext.broadcast({length: np.array(own, np.int64) for length, own in runs.items()})

    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = Window.partitionBy("_part", "length").orderBy(key, "piece", "start", "ids_crc32")
    numbered = held.withColumn("_own", F.row_number().over(own)).join(starts, ["_part", "length"])
    numbered = numbered.select(*cut.columns, (F.col("_start") + F.col("_own") - 1).alias("_number"))
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    arrow, at_length = to_arrow_schema(schema), cut.columns.index("length")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = batch.column(at_length).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()
            sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                plans = shared.value[length]
                chosen = plans[np.searchsorted(plans[:, 1], numbers[rows], side="right") - 1]
                bins, turns = np.divmod(numbers[rows] - chosen[:, 1], chosen[:, 4])
                sequences[rows], offsets[rows] = chosen[:, 2] + bins, chosen[:, 3] + turns * length
            yield pa.RecordBatch.from_arrays([
                *(c.cast(f.type) for c, f in zip(batch.columns, list(arrow)[:-2])), pa.array(sequences), pa.array(offsets),
            ], schema=arrow)

    return numbered.mapInArrow(placed, schema)


def sequences(pieces_with_ids: DataFrame) -> DataFrame:
    """One row per sequence: its ids, its number of documents' pieces, and its ``length``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))     # a sequence's capacity at most
    made = pieces_with_ids.groupBy("sequence_id").agg(parts.alias("parts"))
    return made.select(
        "sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), F.size("parts").alias("n_pieces"),
    ).withColumn("length", F.size("ids"))

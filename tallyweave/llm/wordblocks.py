"""Distinct words of blocks of documents.

Three operators do costly work per distinct word and need its result at every place where the
word stands. Texts are cut into words once. Some megabytes of whole documents make a block; a
block numbers its distinct words, keeps its texts as sequences of those numbers (that is the
exploded position of every word), and sends each distinct word out once, to the partition that
owns the word. Owners see each word from all blocks together, answer it once, and the answers
go back to their blocks, where they are put in place by position.

What is shuffled are the distinct words of blocks, some ten times fewer than words, in bundles
per block and owner. A word of any frequency reaches its owner at most once per block, so there
are no hot keys.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyweave.llm.common import cut, pack, pack_codes, partitions, ranges, starts_of, unpack, unpack_codes, unpack_flat
from tallyweave.session import shared_folder, staging_database

#: Characters of text a block takes before it is closed; a longer document is a block of its own.
BLOCK_CHARS = 8 << 20

Split = Callable[[], Callable[[str], list]]
Answer = Callable[[], Callable[[list, list], list]]


def coded(docs: DataFrame, text: str, keep: list[str], split: Split, counted: str | None = None, store: bool = False, runs: Split | None = None, bucketed: bool = False) -> DataFrame:
    """Blocks of documents and their distinct words.

    ``split`` makes the function that cuts a text (null counts as empty) into words, all str or
    all bytes. ``counted`` names a boolean column: words then carry how often they stand in
    documents where it is true. Rows with ``owner`` -1 are blocks, others words of a block.
    ``runs`` likewise makes a cheaper function that cuts a text into runs, for texts whose words
    are those of their runs, one run after the other; a block then splits each distinct run once.

    Unless ``store``, blocks are made again for each use, which takes the time of cutting texts
    and spares a copy of the corpus. A block's number comes from what it holds, so that blocks
    made from rows in another order (``docs`` should be a table or a checkpoint) find no answers
    and raise an error in ``assembled``. ``bucketed`` stores them by the hash of the block, as a
    table in the shared folder: texts are cut once, and ``assembled`` reads blocks where they lie
    instead of shuffling them to their answers.
    """
    owners = partitions(docs.sparkSession)
    kept = T.StructType([docs.schema[name] for name in keep])
    chosen = docs.select(
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        (F.coalesce(F.col(counted), F.lit(False)) if counted else F.lit(False)).alias("_counted"),
        F.struct(*keep).alias("_kept"),
    )
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("owner", T.IntegerType()),
        T.StructField("rows", T.ArrayType(kept)), T.StructField("sizes", T.BinaryType()),
        T.StructField("payload", T.BinaryType()), T.StructField("sequence", T.BinaryType()),
    ])
    arrow = to_arrow_schema(schema)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_run = split()
        cut_up = runs() if runs else of_run
        start = TaskContext.get().partitionId().to_bytes(8, "little")
        seen, number = xxhash.xxh3_64(start), 0
        rows, codes, flags, chars = [], [], [], 0
        index: defaultdict = defaultdict()
        index.default_factory = index.__len__

        def numbered() -> tuple[list, list[np.ndarray]]:
            """The distinct words of the block and, per document, their numbers."""
            if not runs:
                return list(index), codes
            own: defaultdict = defaultdict()
            own.default_factory = own.__len__
            split_up = list(map(of_run, index))
            lengths = np.fromiter(map(len, split_up), np.int64, len(split_up))
            flat = np.fromiter(map(own.__getitem__, itertools.chain.from_iterable(split_up)), np.int64, int(lengths.sum()))
            starts = starts_of(lengths)
            return list(own), [flat[ranges(starts[c], lengths[c])] for c in codes]

        def closed() -> pa.RecordBatch:
            block = seen.intdigest() - (1 << 63)
            found, places = numbered()
            sizes = list(map(len, places))
            words = [w.encode() if isinstance(w, str) else w for w in found]
            sequence = np.concatenate(places) if places else np.zeros(0, np.int64)
            shares: list[list] = [[] for _ in range(owners)]
            for at, word in enumerate(words):
                shares[zlib.crc32(word) % owners].append((word, at))
            counts = np.zeros(len(words), np.int64)
            if any(flags):
                marked = np.concatenate([c for c, flag in zip(places, flags) if flag])
                counts = np.bincount(marked, minlength=len(words))
            place, at = np.zeros(len(words), np.int64), 0
            out = [(block, -1, b"", None, b"")]
            for owner, share in enumerate(shares):
                if share:
                    share.sort()
                    order = np.fromiter((x[1] for x in share), np.int64, len(share))
                    place[order] = np.arange(at, at + len(share))
                    at += len(share)
                    out.append((block, owner, pack_codes(counts[order]), pack([x[0] for x in share]), None))
            out[0] = (block, -1, pack_codes(np.array(sizes, np.int64)), None, pack_codes(place[sequence]))
            held = pa.concat_arrays(rows)
            offsets = pa.array([0] + [len(held)] * len(out), pa.int32())
            return pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()),
                pa.ListArray.from_arrays(offsets, held, type=arrow.field("rows").type),
                *(pa.array([x[k] for x in out], pa.binary()) for k in (2, 3, 4)),
            ], schema=arrow)

        for batch in batches:
            texts, marks, held = batch.column(0), batch.column(1), batch.column(2).cast(arrow.field("rows").type.value_type)
            taken = 0
            for at in range(batch.num_rows):
                content = texts[at].as_py()
                words = cut_up(content)
                seen.update(content.encode() + b"\0")
                codes.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
                flags.append(marks[at].as_py())
                chars += len(content)
                if chars >= BLOCK_CHARS:
                    rows.append(held.slice(taken, at + 1 - taken))
                    yield closed()
                    taken, number, chars = at + 1, number + 1, 0
                    rows, codes, flags = [], [], []
                    index.clear()
                    seen = xxhash.xxh3_64(start + number.to_bytes(8, "little"))
            if taken < batch.num_rows:
                rows.append(held.slice(taken))
        if codes:
            yield closed()

    made = chosen.mapInArrow(blocks, schema)
    return _bucketed(made, "block") if bucketed else cut(made) if store else made


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """The frame as a table in the shared folder, in buckets by the hash of ``key``; lineage ends here."""
    spark = df.sparkSession
    # Apart from what is staged for a step only, as these tables stay.
    database = f"{staging_database(spark)}_blocks"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{shared_folder(spark)}/{database}'")
    name = f"{database}.buckets_{uuid.uuid4().hex[:12]}"
    df.write.format("parquet").bucketBy(partitions(spark), key).saveAsTable(name)
    return spark.table(name)


def words_of(blocks: DataFrame) -> DataFrame:
    """The distinct words of each block by owner, with their counts."""
    return blocks.where("owner >= 0").select("block", "owner", "sizes", "payload")


def answered(words: DataFrame, answer: Answer) -> DataFrame:
    """Answers for the words of each block; every distinct word is answered once.

    ``answer`` makes a function of an owner's sorted distinct words and their total counts,
    which returns a byte string for each.
    """

    def owner(frame: pd.DataFrame) -> pd.DataFrame:
        lists = [unpack(x) for x in frame["payload"]]
        totals: defaultdict = defaultdict(int)
        for own, sizes in zip(lists, frame["sizes"]):
            for word, n in zip(own, unpack_codes(sizes).tolist()):
                totals[word] += n
        distinct = sorted(totals)
        found = dict(zip(distinct, answer()(distinct, [totals[w] for w in distinct])))
        return pd.DataFrame({
            "block": frame["block"], "owner": frame["owner"],
            "answers": [pack([found[w] for w in own]) for own in lists],
        })

    return words.groupBy("owner").applyInPandas(owner, "block long, owner int, answers binary")


def assembled(blocks: DataFrame, answers: DataFrame, finish: Callable, columns: list[T.StructField]) -> DataFrame:
    """The kept columns of every document with what ``finish`` makes of its words' answers.

    ``finish(codes, sizes, lengths, data)`` gets a block's words as numbers, the number of words
    of each of its documents, and the answers by number (their lengths and their joined bytes);
    it returns an Arrow array per column.
    """
    kept = blocks.schema["rows"].dataType.elementType
    schema = T.StructType([*kept.fields, *columns])
    arrow = to_arrow_schema(schema)

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return arrow.empty_table()
        own = left.column("rows").combine_chunks().flatten()
        if not right.num_rows and unpack_codes(left.column("sizes")[0].as_py()).any():
            raise ValueError("a block was made anew from other rows than before: store the documents first")
        parts = sorted(zip(right.column("owner").to_pylist(), right.column("answers").to_pylist()))
        flat = [unpack_flat(x[1]) for x in parts]
        lengths = np.concatenate([x[0] for x in flat]) if flat else np.zeros(0, np.uint32)
        made = finish(
            unpack_codes(left.column("sequence")[0].as_py()), unpack_codes(left.column("sizes")[0].as_py()),
            lengths, b"".join(x[1] for x in flat),
        )
        return pa.Table.from_arrays([
            *(own.field(k).cast(arrow.field(k).type) for k in range(len(kept.fields))), *made,
        ], schema=arrow)

    left = blocks.where("owner < 0").select("block", "rows", "sizes", "sequence")
    return left.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(block, schema)

"""Byte-level BPE encoding and decoding over a global shuffle of distinct pre-tokens."""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyweave.llm.common import ranges, starts_of
from tallyweave.llm.wordblocks import answered, assembled, coded, words_of

#: The characters of Unicode's property White_Space, which ``\s`` of ``PATTERN`` stands for.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs for ``public_tokenizers.PATTERN``: its matches are white space alone, or other characters with at
#: most one blank before them, and beyond its end a match only depends on whether white space follows.
RUNS = rf" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]"


@functools.cache
def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank per line. Read on the driver, of fixed size."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def _encoding(name: int, shared) -> tiktoken.Encoding:
    pattern, ranks = shared.value
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoder(spark: SparkSession, ranks: dict[bytes, int], pattern: str) -> Callable[[], Callable[[str], list[int]]]:
    """What a task calls to get a function from a text to its ids."""
    shared = spark.sparkContext.broadcast((pattern, ranks))     # a vocabulary, of fixed size
    return lambda: _encoding(id(shared), shared).encode_ordinary


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: list[str], text: str = "text", ids: str = "ids", runs: str | None = None) -> DataFrame:
    """Columns ``keep`` and the token ids of every whole text, as ``array<int>``.

    Each match of ``pattern`` is merged by itself; no special tokens. Every distinct match is
    encoded once in the whole corpus. A null or empty text has no ids. Rows are kept as they
    are, repeated ones too; further columns of ``docs`` play no part.

    ``runs`` is a pattern of the standard library whose matches cover a text and each hold
    whole matches of ``pattern``, the same ones wherever the run stands: a block of documents
    then cuts each distinct run by ``pattern`` once. ``RUNS`` is one for ``PATTERN``.
    """
    shared = docs.sparkSession.sparkContext.broadcast((pattern, ranks))     # a vocabulary, of fixed size

    def split():
        return regex.compile(pattern).findall

    def answer():
        encoding = _encoding(id(shared), shared)

        def encoded(words: list[bytes], counts: list[int]) -> list[bytes]:
            lists = map(encoding.encode_ordinary, (w.decode() for w in words))
            return [np.array(x, dtype="<u4").tobytes() for x in lists]

        return encoded

    def finish(codes, sizes, lengths, data):
        tokens = (lengths // 4).astype(np.int64)
        each = tokens[codes]
        flat = np.frombuffer(data, "<u4")[ranges(starts_of(tokens)[codes], each)].astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(sizes)])]
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat), type=pa.list_(item))]

    column = T.StructField(ids, T.ArrayType(T.IntegerType(), False))
    item = to_arrow_schema(T.StructType([column])).field(0).type.value_field
    cheap = (lambda: re.compile(runs).findall) if runs else None
    blocks = coded(docs, text, keep, split, runs=cheap, bucketed=True)
    return assembled(blocks, answered(words_of(blocks), answer), finish, [column])


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded", digest: str | None = None) -> DataFrame:
    """Adds the bytes that the ids stand for, as ``binary``; null ids give no bytes.

    The token-byte table has one row per token of the vocabulary, a fixed number, so every task
    holds it and the join by id is a look-up. An id outside the table is an error. ``digest``
    names a further column: SHA-256 of the ids as little-endian 32-bit numbers.
    """
    tokens: list = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)
    fields = [T.StructField(out, T.BinaryType())] + [T.StructField(digest, T.StringType())] * bool(digest)
    schema = T.StructType([*encoded.schema.fields, *fields])
    arrow = to_arrow_schema(schema)
    place = encoded.columns.index(ids)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look_up = shared.value.__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = part.column(place)
                texts, digests = [], []
                for at in range(part.num_rows):
                    own = lists[at].values
                    own = np.zeros(0, "<u4") if own is None else own.to_numpy().astype("<u4")
                    texts.append(b"".join(map(look_up, own.tolist())))
                    if digest:
                        digests.append(hashlib.sha256(own.tobytes()).hexdigest())
                made = [pa.array(texts, pa.binary())] + [pa.array(digests, pa.string())] * bool(digest)
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(part.columns, arrow)), *made], schema=arrow)

    return encoded.mapInArrow(joined, schema)


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, runs: str | None = None) -> DataFrame:
    """Per document: the number of ids, a digest of them, and one of the bytes they decode to."""
    decoded = decode(encode(docs, ranks, pattern, ["doc_id"], runs=runs), ranks, digest="ids_sha256")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

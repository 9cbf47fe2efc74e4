"""Token ids in training order: a keyed permutation of all sequences, written as fixed-stride shards."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import cut, partitions

#: Tokens of a sequence and sequences of a shard.
LENGTH = 1024
SHARD = 256
#: Rounds of the permutation.
ROUNDS = 6

Encoder = Callable[[], Callable[[str], list[int]]]


def half_bits(count: int) -> int:
    """Half the bits of the smallest even-bit domain that holds ``count`` values."""
    return max(1, ((count - 1).bit_length() + 1) // 2)


def _round(values: np.ndarray, key: int, number: int, mask: np.uint64) -> np.ndarray:
    salt = int.from_bytes(hashlib.blake2b(f"{key}/{number}".encode(), digest_size=8).digest(), "little")
    mixed = (values + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(salt | 1)
    return (mixed ^ (mixed >> np.uint64(33))) & mask


def _network(values: np.ndarray, bits: int, key: int, rounds: list[int]) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = values >> np.uint64(bits), values & mask
    for number in rounds:
        left, right = right, left ^ _round(right, key, number, mask)
    return (left << np.uint64(bits)) | right


def permuted(values: np.ndarray, count: int, key: int, back: bool = False) -> np.ndarray:
    """Where a keyed permutation of ``range(count)`` sends the values; ``back`` for its inverse.

    A Feistel network permutes the next power of four; a value that falls outside walks on along
    its cycle until it is inside, which takes less than four steps on average.
    """
    values = np.asarray(values, np.uint64).copy()
    bits, open_ = half_bits(count), np.arange(len(values))
    while len(open_):
        own = values[open_]
        if back:    # the same network with its rounds and halves turned round
            own = _swapped(_network(_swapped(own, bits), bits, key, list(range(ROUNDS))[::-1]), bits)
        else:
            own = _network(own, bits, key, list(range(ROUNDS)))
        values[open_] = own
        open_ = open_[own >= count]
    return values.astype(np.int64)


def _swapped(values: np.ndarray, bits: int) -> np.ndarray:
    return ((values & np.uint64((1 << bits) - 1)) << np.uint64(bits)) | (values >> np.uint64(bits))


def sequences(docs: DataFrame, encoder: Encoder, separator: int, text: str = "text", length: int = LENGTH) -> DataFrame:
    """All texts as token sequences of one length: ``ordinal`` and compressed ``tokens``.

    The documents of an input partition follow each other, a separator after each; the stream is
    cut every ``length`` tokens and the last piece is filled up with separators. A null or empty
    text is its separator alone; repeated rows are repeated. Ordinals are dense: the sequences of
    a partition follow those of the partitions before it, of which only counts reach the driver.
    """
    kind = token_type(separator)

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, pack = encoder(), zstandard.ZstdCompressor(level=1).compress
        task, index, rest = TaskContext.get().partitionId(), 0, np.zeros(0, kind)
        for frame in frames:
            for start in range(0, len(frame), 256):
                parts = [rest]
                for content in frame["_text"].iloc[start:start + 256]:
                    parts.append(np.array([*(encode(content) if content else ()), separator], kind))
                stream = np.concatenate(parts)
                whole = len(stream) // length
                rest = stream[whole * length:]
                if whole:
                    yield pd.DataFrame({
                        "task": task, "index": range(index, index + whole),
                        "tokens": [pack(x.tobytes()) for x in stream[:whole * length].reshape(whole, length)],
                    })
                    index += whole
        if len(rest):
            last = np.full(length, separator, kind)
            last[:len(rest)] = rest
            yield pd.DataFrame({"task": [task], "index": [index], "tokens": [pack(last.tobytes())]})

    found = cut(docs.select(F.col(text).alias("_text")).mapInPandas(made, "task int, index long, tokens binary"))
    counts = sorted((r["task"], r["n"]) for r in found.groupBy("task").agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for task, n in counts:
        starts.append((task, total))
        total += n
    offsets = docs.sparkSession.createDataFrame(starts, "task int, start long")
    # One row per input partition.
    return found.join(F.broadcast(offsets), "task").select((F.col("start") + F.col("index")).alias("ordinal"), "tokens", F.lit(total).alias("total"))


def token_type(largest: int) -> np.dtype:
    """Little-endian unsigned integers that hold token ids up to ``largest``."""
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


def shards(found: DataFrame, key: int, shard: int = SHARD) -> DataFrame:
    """Sequences of ``sequences`` in the order of a keyed permutation, as fixed-stride shards.

    Each sequence has a global slot. Slots are dealt out by range, so a task holds whole shards
    and writes them one after the other: ``shard``, ``first_slot``, ``n_sequences``, ``stride``
    (bytes of a sequence) and ``payload``, in which slot s starts at ``(s - first_slot) *
    stride``. Any slot is found by arithmetic, and a lost task makes the same shards again.
    """
    parts = partitions(found.sparkSession)

    @F.pandas_udf("long")
    def slot(ordinals: pd.Series, totals: pd.Series) -> pd.Series:
        return pd.Series(permuted(ordinals.to_numpy(), int(totals.iloc[0]), key)) if len(ordinals) else ordinals

    def written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        held, first = [], 0
        for frame in frames:
            done = []
            for at, tokens in zip(frame["slot"].tolist(), frame["tokens"]):
                if held and at // shard != first // shard:
                    done.append(_shard(held, first, shard))
                    held = []
                if not held:
                    first = at
                held.append(unpack(tokens))
            if done:
                yield pd.DataFrame(done, columns=list(SHARD_COLUMNS))
        if held:
            yield pd.DataFrame([_shard(held, first, shard)], columns=list(SHARD_COLUMNS))

    slotted = found.withColumn("slot", slot("ordinal", "total"))
    share = F.floor(F.floor(F.col("slot") / shard) * parts / F.ceil(F.col("total") / shard)).cast("int")
    dealt = slotted.withColumn("part", share).repartitionById(parts, F.col("part"))
    ordered = dealt.select("slot", "tokens").sortWithinPartitions("slot")
    return ordered.mapInPandas(written, "shard long, first_slot long, n_sequences int, stride int, payload binary")


SHARD_COLUMNS = ("shard", "first_slot", "n_sequences", "stride", "payload")


def _shard(held: list[bytes], first: int, shard: int) -> tuple:
    return first // shard, first, len(held), len(held[0]), b"".join(held)


def read_from(written: DataFrame, slot: int, shard: int = SHARD) -> DataFrame:
    """Sequences from a slot on, as ``slot`` and ``tokens`` (bytes), from stored shards.

    ``shard`` is the number of sequences a whole shard was written with. The number of a shard
    is compared with that of the slot, a filter the scan takes: files and row groups of earlier
    shards are left out by their statistics. A slot beyond the end gives no rows, one below 0
    all; an empty table gives none.
    """
    places = F.explode(F.sequence(F.lit(0), F.col("n_sequences") - 1)).alias("k")
    cells = written.where(F.col("shard") >= max(0, slot) // shard).select("*", places)
    return cells.select(
        (F.col("first_slot") + F.col("k")).alias("slot"),
        F.substring("payload", F.col("k") * F.col("stride") + 1, F.col("stride")).alias("tokens"),
    ).where(F.col("slot") >= slot)

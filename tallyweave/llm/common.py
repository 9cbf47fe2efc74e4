"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import functools

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.session import shared_folder

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The frame as checkpointed in the folder all executors share; lineage ends here."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions the cluster is set to, which follows its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % by


def pack(items: list[bytes]) -> bytes:
    """Byte strings as one compressed byte string."""
    lengths = np.fromiter(map(len, items), dtype="<u4", count=len(items))
    return zstandard.ZstdCompressor(level=3).compress(np.uint32(len(items)).tobytes() + lengths.tobytes() + b"".join(items))


def unpack_flat(packed: bytes) -> tuple[np.ndarray, bytes]:
    """The lengths and the joined bytes of packed items."""
    raw = zstandard.ZstdDecompressor().decompress(packed)
    count = int(np.frombuffer(raw, "<u4", 1)[0])
    return np.frombuffer(raw, "<u4", count, 4), raw[4 + 4 * count:]


def unpack(packed: bytes) -> list[bytes]:
    lengths, data = unpack_flat(packed)
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    starts = [0, *ends[:-1]]
    return [data[a:b] for a, b in zip(starts, ends)]


def pack_codes(codes: np.ndarray) -> bytes:
    """Whole numbers below 2**32 as compressed planes of their bytes."""
    planes = np.ascontiguousarray(codes, dtype="<u4").view(np.uint8).reshape(-1, 4)
    used = 4 if codes.size and codes.max() >= 1 << 24 else 3
    raw = b"".join(planes[:, k].tobytes() for k in range(used))
    return bytes([used]) + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack_codes(packed: bytes) -> np.ndarray:
    used = packed[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), np.uint8)
    planes = raw.reshape(used, -1)
    codes = np.zeros(planes.shape[1], dtype=np.int64)
    for k in range(used):
        codes |= planes[k].astype(np.int64) << (8 * k)
    return codes


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after the other."""
    lengths = lengths.astype(np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts.astype(np.int64) - before, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths, dtype=np.int64)
    return ends - lengths


@functools.cache
def lower_ascii() -> bytes:
    """Translation table that lower-cases A-Z and nothing else."""
    return bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

"""Similarity join of texts by the Jaccard index of their word n-grams, over MinHash bands."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import cut
from tallyweave.llm.components import connected
from tallyweave.llm.rows import IDENTITY, join_rows, wrapped

#: Words of an n-gram, and the similarity in percent from which two texts are linked.
GRAM = 5
SIMILAR = 80
#: Rows of a band, and the share of links at exactly that similarity that must be found.
ROWS = 6
RECALL = 0.999
#: Texts of a bucket that one task compares with as many others.
BLOCK = 512
#: Rows that are hashed at a time; with their n-grams a whole Arrow batch of long texts would be some hundred MB.
ROWS_AT_ONCE = 500
#: Words whose hash a task remembers, some 200 bytes each.
REMEMBERED = 100_000
#: Pairs of a block from which they are counted by matrix product.
DENSE_PAIRS = 256

WORD = re.compile(r"[^\W_]+")


def bands_for(similarity: float, recall: float, rows: int = ROWS) -> int:
    """The fewest bands of ``rows`` rows that find ``recall`` of the pairs of this similarity."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


BANDS = bands_for(SIMILAR / 100, RECALL)


def _odd(count: int, seed: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(b"%d/%d" % (seed, k)) | 1 for k in range(count)], np.uint64)


PLACES = _odd(GRAM, 3)
MULTIPLIERS, SHIFTS = (_odd(BANDS * ROWS, k).astype(np.uint32)[:, None] for k in (1, 2))


class Hashes(dict):
    """Word to its 64-bit hash; forgets all when it grows large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode())
        return value


def grams(text: str | None, hashes: Hashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's n-grams; all its words are one if they are fewer."""
    words = WORD.findall((text or "").lower())
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(GRAM, len(own))
    if not size:
        return own
    runs = np.zeros(len(own) - size + 1, np.uint64)
    for k in range(size):
        runs = (runs ^ own[k:len(own) - size + 1 + k]) * PLACES[k]
        runs ^= runs >> np.uint64(29)
    return np.unique(runs)


def signature(own: np.ndarray) -> list[int]:
    """One hash per band, over the smallest values of ``ROWS`` permutations of 32-bit hashes."""
    folded = (own >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(folded), 1024):
        values = folded[start:start + 1024] ^ SHIFTS
        values *= MULTIPLIERS
        np.minimum(least, values.min(axis=1), out=least)
    return [xxhash.xxh3_64_intdigest(least[k:k + ROWS].tobytes()) - (1 << 63) for k in range(0, BANDS * ROWS, ROWS)]


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: identity, class, number of links, group.

    Texts with the same n-grams (five words; lower case, letters and digits only) form a class;
    ``class_id`` is its lowest key. ``n_links`` is the number of other classes whose Jaccard
    index with it is 0.8 or more: copies are not expanded, and no pair of a group is written
    out. ``group_id`` is the lowest key of all texts reached over links. A text without a word
    is a class and a group of its own, as null or empty texts say nothing about each other.
    Repeated rows fall into one class. A null key is lower than any other.

    Classes are hashed in bands, whose number follows from ``RECALL``, and meet in the buckets
    of their band hashes; buckets with the same texts are one. A bucket above ``BLOCK`` texts is dealt out in blocks, and every pair
    of blocks is a task of its own. A pair counts only in the first band that it shares, is
    compared on full n-gram sets, and reaches no further than sums and a spanning forest.
    """
    rows = wrapped(docs, key, text)
    signed = rows.select(*IDENTITY, "_text").mapInPandas(
        _signed, f"_key {docs.schema[key].dataType.simpleString()}, _id long, _id2 int, node binary, size int, bands array<long>",
    )
    signed = cut(signed)
    name = F.struct(*IDENTITY)
    with_words = signed.where(F.col("node").isNotNull())
    classes = with_words.groupBy("node").agg(F.min(name).alias("first"), F.any_value("bands").alias("bands"), F.any_value("size").alias("size"))
    classes = cut(classes)

    buckets = classes.select("node", F.posexplode("bands").alias("band", "bucket"))
    full = buckets.groupBy("band", "bucket").agg(
        F.count("*").alias("texts"), F.bit_xor(F.xxhash64("node")).alias("all"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("all2"),
    ).where("texts > 1")
    # Buckets that hold the same texts are one: the first of them.
    full = full.groupBy("texts", "all", "all2").agg(F.min(F.struct("band", "bucket")).alias("at")).select("texts", "at.*")
    blocks = F.ceil(F.col("texts") / BLOCK).cast("int")
    members = buckets.join(full, ["band", "bucket"]).select(
        "node", "band", "bucket", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int").alias("block"),
    )
    members = cut(members)

    # One text per class that shares a bucket, with its n-grams.
    needed = members.select("node").distinct().join(classes, "node").select("node", "bands", "size", "first.*")
    content = join_rows(rows.select(*IDENTITY, "_text"), needed, "inner").drop(*IDENTITY)
    content = content.groupBy("node").agg(*(F.any_value(c).alias(c) for c in ("bands", "size", "_text")))     # repeated rows
    sets = content.mapInPandas(_with_grams, "node binary, bands array<long>, size int, grams binary")
    dealt = members.select("node", "band", "bucket", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pieces = dealt.join(sets, "node").select(
        "*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    found = cut(pieces.groupBy("band", "bucket", "low", "high").applyInPandas(_compared, "node binary, links long, to binary"))

    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    groups = connected(found.where(F.col("to").isNotNull()).select(F.col("node").alias("a"), F.col("to").alias("b")))
    placed = classes.join(links, "node", "left").join(groups, "node", "left").select(
        "node", "first", "n_links", F.coalesce("component", "node").alias("component"),
    )
    firsts = placed.groupBy("component").agg(F.min("first").alias("leader"))
    placed = placed.join(firsts, "component").select("node", "first", "n_links", "leader")
    joined = signed.select(*IDENTITY, "node").join(placed, "node", "left")
    return joined.select(
        *IDENTITY, F.coalesce("first", name).alias("first"), F.coalesce("leader", name).alias("leader"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of ``linked``, that of the lowest key, with all its columns."""
    rows = wrapped(docs, key, text)
    marks = linked(docs, key, text)
    leaders = marks.where(F.struct(*IDENTITY).eqNullSafe(F.col("leader"))).select(*IDENTITY).distinct()
    kept = join_rows(rows, leaders, "left_semi")
    # Rows that repeat a leader, but for texts without words, which stay.
    wordless = ~F.coalesce(F.col("_text"), F.lit("")).rlike(r"[\p{L}\p{N}]")
    once = kept.where(~wordless).groupBy(*IDENTITY).agg(F.any_value("_row").alias("_row"))
    return once.select("_row.*").unionByName(kept.where(wordless).select("_row.*"))


def _slices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for start in range(0, len(frame), ROWS_AT_ONCE):
            yield frame.iloc[start:start + ROWS_AT_ONCE].copy()


def _signed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = Hashes()
    for frame in _slices(frames):
        nodes, sizes, bands = [], [], []
        for content in frame.pop("_text"):
            own = grams(content, hashes)
            sizes.append(len(own))
            nodes.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
            bands.append(signature(own) if len(own) else None)
        yield frame.assign(node=nodes, size=sizes, bands=bands)


def _with_grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = Hashes()
    for frame in _slices(frames):
        yield frame.assign(grams=[grams(x, hashes).tobytes() for x in frame.pop("_text")])[["node", "bands", "size", "grams"]]


def _compared(frame: pd.DataFrame) -> pd.DataFrame:
    """Links of the pairs between two blocks of a bucket, per text, and a forest that spans them."""
    band = int(frame["band"].iloc[0])
    low, high = int(frame["low"].iloc[0]), int(frame["high"].iloc[0])
    # Between two blocks every text stands once; within one, as the pair (low, low) has one row per text too.
    frame = frame.sort_values("node", ignore_index=True)
    block, sizes = frame["block"].to_numpy(), frame["size"].to_numpy()
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    bands = np.array(frame["bands"].tolist(), np.int64)
    sets = [np.frombuffer(x, np.uint64) for x in frame["grams"]]
    wanted = np.minimum(sizes[left][:, None], sizes[right]) * 100 >= SIMILAR * np.maximum(sizes[left][:, None], sizes[right])
    for k in range(band):
        wanted &= bands[left, k][:, None] != bands[right, k]
    if low == high:
        wanted &= left[:, None] < right
    a, b = np.nonzero(wanted)
    if len(a) < DENSE_PAIRS:
        common = np.array([len(np.intersect1d(sets[left[i]], sets[right[j]], assume_unique=True)) for i, j in zip(a, b)], np.int64)
    else:
        common = _products([sets[i] for i in left], [sets[j] for j in right])[a, b]
    union = sizes[left[a]] + sizes[right[b]] - common
    hit = common * 100 >= SIMILAR * union
    a, b = left[a[hit]], right[b[hit]]
    links = np.bincount(a, minlength=len(frame)) + np.bincount(b, minlength=len(frame))
    to = _forest(a, b, len(frame))
    nodes = frame["node"]
    out = pd.DataFrame({"node": nodes, "links": links, "to": [nodes[k] if k >= 0 else None for k in to]})
    return out[(links > 0)]


def _products(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices a slice of n-grams at a time."""
    flat = [np.concatenate(x) for x in (left, right)]
    shared = np.intersect1d(*(np.unique(x) for x in flat), assume_unique=True)
    total = np.zeros((len(left), len(right)), np.float32)
    owners = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    places = [np.searchsorted(shared, x) for x in flat]
    if not len(shared):
        return total.astype(np.int64)
    held = [shared[np.minimum(p, len(shared) - 1)] == x for p, x in zip(places, flat)]
    for start in range(0, len(shared), width):
        sides = []
        for side, (owner, place, own) in enumerate(zip(owners, places, held)):
            here = own & (place >= start) & (place < start + width)
            matrix = np.zeros((len((left, right)[side]), min(width, len(shared) - start)), np.float32)
            matrix[owner[here], place[here] - start] = 1
            sides.append(matrix)
        total += sides[0] @ sides[1].T
    return np.rint(total).astype(np.int64)


def _forest(a: np.ndarray, b: np.ndarray, count: int) -> list[int]:
    """For each text, one it is linked to over a chain of others in turn; -1 for the roots."""
    parent = list(range(count))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = [root(x) for x in range(count)]
    return [r if r != x else -1 for x, r in enumerate(roots)]

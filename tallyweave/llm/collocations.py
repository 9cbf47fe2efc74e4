"""Collocations: phrases of two or three words that stand together more often than their parts.

Counts come from suffix subtrees, built group by group. A suffix starts at any word and is cut
off after three. Vertical partitioning deals the suffixes to groups by their first words: a
prefix is one word; where more suffixes start with it than a task should hold, it is split by
the second word, and then by the third. Prefixes are laid side by side, in order, until a group
is full. So a group is a range of the sorted suffixes, whatever the frequency of a word. A task
sorts the suffixes of its group, which are the leaves of its subtree; the count of a phrase is
the total of the leaves below its node.

Words stand for numbers, given over all documents to words that are frequent enough; a phrase
with any other word cannot be frequent either, so such words end a suffix as marks do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.common import lower_ascii
from tallyweave.llm.running import laid, running

#: Suffixes a group should hold, and the characters of text a block takes before it is closed.
BUDGET = 1 << 20
BLOCK_CHARS = 8 << 20
#: Language of documents without one.
UNKNOWN = "und"

#: A mark that ends a piece, as one byte that no UTF-8 text holds.
END = b"\xff"
SUFFIX = ("a", "b", "c")


def words_of(text: str) -> list[bytes]:
    """The words of a text, with END between its pieces."""
    marked = text.encode().translate(_marks())
    return marked.replace(b"\n", b" \xff ").split()


def _marks() -> bytes:
    table = bytearray(lower_ascii())
    for mark in b".,;:!?\n\x0b\x0c\r":
        table[mark] = 10
    return bytes(table)


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of their bytes."""
    used = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(numbers, "<i8").view(np.uint8).reshape(-1, 8)[:, :used]
    return bytes([used]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.T).tobytes())


def unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), np.uint8)
    planes = np.zeros((raw.size // packed[0], 8), np.uint8)
    planes[:, : packed[0]] = raw.reshape(packed[0], -1).T
    return planes.view("<i8").ravel()


def distinct(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct rows and how often each stands (or the sum of its counts)."""
    size = len(columns[0])
    if not size:
        return columns, np.zeros(0, np.int64)
    bits = [max(1, int(c.max()).bit_length()) for c in columns]
    if sum(bits) < 63:
        key = np.zeros(size, np.int64)
        for column, width in zip(columns, bits):
            key = key << width | column
        order = None if counts is None else np.argsort(key, kind="stable")
        key = np.sort(key) if order is None else key[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        rows, key = [], key[starts]
        for width in reversed(bits):
            rows.append(key & ((1 << width) - 1))
            key = key >> width
        rows.reverse()
    else:
        order = np.lexsort(columns[::-1])
        ordered = [c[order] for c in columns]
        changed = np.any([c[1:] != c[:-1] for c in ordered], axis=0)
        starts = np.flatnonzero(np.append(True, changed))
        rows = [c[starts] for c in ordered]
    if counts is None:
        return rows, np.diff(np.append(starts, size))
    return rows, np.add.reduceat(counts[order], starts)


def blocks(docs: DataFrame, lang: Column, text: Column) -> DataFrame:
    """Some megabytes of whole documents of a language: distinct words, their counts, and the
    texts as places in that list, from 1 on (0: the end of a piece)."""
    schema = "block long, lang string, words array<string>, counts array<long>, total long, codes binary"
    arrow = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())),
                       ("counts", pa.list_(pa.int64())), ("total", pa.int64()), ("codes", pa.binary())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: dict[str, tuple[dict, list]] = {}
        chars = 0

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for own, (places, codes) in held.items():
                sequence = np.concatenate(codes)
                counts = np.bincount(sequence, minlength=len(places))[1:]
                words = pa.array(list(places)[1:], pa.binary()).cast(pa.string())
                ends = pa.array([0, len(words)], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.array([own]), pa.ListArray.from_arrays(ends, words),
                    pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
                    pa.array([int(counts.sum())], pa.int64()), pa.array([pack(sequence)], pa.binary()),
                ], schema=arrow)
                number += 1

        for batch in batches:
            for own, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = content.as_py()
                places, codes = held.setdefault(own, ({END: 0}, []))
                found = words_of(content)
                for word in found:
                    if word not in places:
                        places[word] = len(places)
                codes.append(np.fromiter(map(places.__getitem__, found), np.int64, len(found)))
                codes.append(np.zeros(1, np.int64))
                chars += len(content)
                if chars >= BLOCK_CHARS:
                    yield from closed()
                    held, chars = {}, 0
        yield from closed()

    return docs.select(lang.alias("lang"), text.alias("text")).mapInArrow(made, schema)


def encoded(cut: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Blocks as sequences of the numbers of their frequent words; other words are 0."""
    words = cut.select("block", "lang", F.posexplode("words").alias("place", "word"))
    known = words.join(vocabulary.select("lang", "word", "id"), ["lang", "word"])
    own = known.groupBy("block").agg(F.collect_list("place").alias("places"), F.collect_list("id").alias("ids"))     # of one block

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, places, ids in zip(*(batch.column(k) for k in range(3))):
                sequence = unpack(codes.as_py())
                table = np.zeros(int(sequence.max(initial=0)) + 1, np.int64)
                if places.is_valid:
                    table[places.values.to_numpy() + 1] = ids.values.to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array([pack(table[sequence])], pa.binary())], names=["codes"])

    return cut.select("block", "codes").join(own, "block", "left").select("codes", "places", "ids").mapInArrow(numbered, "codes binary")


def suffixes(sequence: np.ndarray) -> list[np.ndarray]:
    """First, second and third word of every suffix of two words or more (third 0: none)."""
    after = np.append(sequence[1:], 0)
    third = np.where(after == 0, 0, np.append(after[1:], 0))
    there = (sequence != 0) & (after != 0)
    return [sequence[there], after[there], third[there]]


def prefixes(texts: DataFrame, heavy: list[tuple], depth: int) -> DataFrame:
    """How many suffixes start with each prefix of ``depth`` words that goes on from a heavy one."""
    names = SUFFIX[:depth]
    shared = texts.sparkSession.sparkContext.broadcast([np.array(x, np.int64) for x in zip(*sorted(heavy))])    # suffixes / BUDGET rows at most

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes in batch.column(0):
                columns = suffixes(unpack(codes.as_py()))
                for k in range(depth - 1):      # a first sieve word by word
                    there = np.isin(columns[k], shared.value[k])
                    columns = [c[there] for c in columns]
                rows, counts = distinct(columns[:depth])
                if depth == 3:
                    chosen = set(zip(*(x.tolist() for x in shared.value)))
                    there = np.fromiter((p in chosen for p in zip(rows[0].tolist(), rows[1].tolist())), bool, len(counts))
                    rows, counts = [r[there] for r in rows], counts[there]
                yield pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array(counts)], names=[*names, "f"])

    found = texts.mapInArrow(counted, ", ".join(f"{n} long" for n in names) + ", f long")
    return laid(found.groupBy(*names).agg(F.sum("f").alias("f")), "prefixes")


def partitioned(texts: DataFrame, vocabulary: DataFrame, budget: int) -> tuple[list[tuple], DataFrame | None]:
    """The first prefix of each group, and the counts of pairs that are split between groups."""
    spark, none = texts.sparkSession, F.lit(0).cast("long")
    parts = [vocabulary.where(F.col("f") <= budget).select(F.col("id").alias("a"), none.alias("b"), none.alias("c"), "f")]
    # Words and pairs above the budget: as many as budgets fit into the corpus, at most.
    heavy = [(r["id"],) for r in vocabulary.where(F.col("f") > budget).select("id").collect()]
    split = None
    if heavy:
        pairs = prefixes(texts, heavy, 2)
        parts.append(pairs.where(F.col("f") <= budget).select("a", "b", none.alias("c"), "f"))
        split = pairs.where(F.col("f") > budget)
        heavy = [(r["a"], r["b"]) for r in split.select("a", "b").collect()]
        if heavy:
            parts.append(prefixes(texts, heavy, 3).select("a", "b", "c", "f"))
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    placed = running(every, SUFFIX, "before", F.col("f"))
    first = placed.groupBy(F.floor(F.col("before") / budget)).agg(F.min(F.struct(*SUFFIX)).alias("first"))
    return sorted(tuple(r["first"]) for r in first.collect()), split    # a row per budget of the corpus


def places_of(columns: list[np.ndarray], firsts: list[np.ndarray]) -> np.ndarray:
    """Where each group starts among sorted distinct suffixes."""
    starts = np.searchsorted(columns[0], firsts[0])
    for k in np.flatnonzero(firsts[1]).tolist():       # prefixes of more than one word
        low, high = starts[k], np.searchsorted(columns[0], firsts[0][k], side="right")
        for column, first in zip(columns[1:], firsts[1:]):
            own = column[low:high]
            low, high = low + np.searchsorted(own, first[k]), low + np.searchsorted(own, first[k], side="right")
            if not first[k]:
                break
        starts[k] = low
    return np.append(starts, len(columns[0]))


def subtrees(texts: DataFrame, firsts: list[tuple], split: list[tuple], least: int) -> DataFrame:
    """Nodes of two and three words (third 0: none) with ``least`` suffixes or more, by their leaves.

    The pairs in ``split`` have leaves in several groups; their own counts are known before.
    """
    shared = texts.sparkSession.sparkContext.broadcast(([np.array(x, np.int64) for x in zip(*firsts)], set(split)))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes in batch.column(0):
                rows, counts = distinct(suffixes(unpack(codes.as_py())))
                starts = places_of(rows, shared.value[0])
                there = np.flatnonzero(starts[1:] > starts[:-1])
                slices = [slice(starts[k], starts[k + 1]) for k in there]
                yield pa.RecordBatch.from_arrays([
                    pa.array(there, pa.int64()),
                    *(pa.array([pack(column[s]) for s in slices], pa.binary()) for column in (*rows, counts)),
                ], names=["group", *SUFFIX, "n"])

    def grown(frame: pd.DataFrame) -> pd.DataFrame:
        columns = [np.concatenate([unpack(x) for x in frame[name]]) for name in (*SUFFIX, "n")]
        leaves, totals = distinct(columns[:3], columns[3])
        starts = np.flatnonzero(np.append(True, (leaves[0][1:] != leaves[0][:-1]) | (leaves[1][1:] != leaves[1][:-1])))
        pairs = [leaves[0][starts], leaves[1][starts], np.zeros(len(starts), np.int64)]
        below = np.add.reduceat(totals, starts)
        often = (totals >= least) & (leaves[2] != 0)
        own = below >= least
        if shared.value[1]:
            own &= np.fromiter((p not in shared.value[1] for p in zip(pairs[0].tolist(), pairs[1].tolist())), bool, len(starts))
        nodes = [np.concatenate([x[own], y[often]]) for x, y in zip((*pairs, below), (*leaves, totals))]
        return pd.DataFrame(dict(zip((*SUFFIX, "n"), nodes)))

    rows = texts.mapInArrow(dealt, "group long, a binary, b binary, c binary, n binary")
    return rows.groupBy("group").applyInPandas(grown, "a long, b long, c long, n long")


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (l * r)), exact: products are decimals, the division is whole."""
    wide = "cast({} as decimal(16,0))"
    a, left, right = (wide.format(x) for x in (a, left, right))
    return F.expr(f"({a} * {a} * cast(1000000 as decimal(7,0))) div ({left} * {right})")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, lang: str = "lang", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are lower-cased in A-Z and cut into pieces at ``. , ; : ! ?`` and line ends, pieces into
    words at spaces and tabs. A candidate has two or three words and stands ``least`` times or
    more; its score is that of its weakest cut, ``l`` and ``r`` being the counts of the parts, and
    of equal cuts the first. A pair within a candidate of three words that stands at least half
    as often is left out. ``n`` counts all words of the language. Ties go by ``a``, then by the
    bytes of the phrase. A null language is ``und``, a null text empty; repeated rows count each
    time; an empty table has no phrases; texts of any length are taken whole. Other columns of
    ``docs`` play no part.
    """
    cut = laid(blocks(docs, F.coalesce(F.col(lang), F.lit(UNKNOWN)), F.coalesce(F.col(text), F.lit(""))), "blocks")
    sums = cut.groupBy("lang").agg(F.sum("total").alias("n"))
    words = cut.select("lang", F.explode(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("f"))).alias("w"))
    totals = words.groupBy("lang", F.col("w.word").alias("word")).agg(F.sum("w.f").alias("f")).where(F.col("f") >= least)
    vocabulary = laid(running(totals, ["lang", "word"], "before").withColumn("id", F.col("before") + 1).drop("before"), "vocabulary")
    texts = laid(encoded(cut, vocabulary), "encoded")

    firsts, split = partitioned(texts, vocabulary, budget)
    if not firsts:
        firsts = [(0, 0, 0)]
    apart = [] if split is None else [tuple(r) for r in split.select("a", "b").collect()]
    nodes = subtrees(texts, firsts, apart, least)
    if apart:
        nodes = nodes.union(split.select("a", "b", F.lit(0).cast("long"), "f"))
    return ranked(laid(nodes, "nodes"), vocabulary, sums, top)


def ranked(nodes: DataFrame, vocabulary: DataFrame, sums: DataFrame, top: int) -> DataFrame:
    """Scores of all candidates, without pairs that a longer one covers, and the best of each language."""
    pairs = nodes.where("c = 0").select("a", "b", "n")
    triples = nodes.where("c > 0")

    def word(at: str, *further: str) -> DataFrame:
        return vocabulary.select(F.col("id").alias(at), F.col("word").alias(f"word_{at}"), F.col("f").alias(f"f_{at}"), *further)

    longer = triples.select("a", "b", "n").union(triples.select("b", "c", "n")).groupBy("a", "b").agg(F.max("n").alias("longer"))
    open_pairs = pairs.join(longer, ["a", "b"], "left").where("longer IS NULL OR 100 * longer < 50 * n")
    two = open_pairs.join(word("a", "lang"), "a").join(word("b"), "b").select(
        "lang", F.concat_ws(" ", "word_a", "word_b").alias("phrase"), F.col("n").alias("count"),
        F.col("f_a").alias("l"), F.col("f_b").alias("r"), score("n", "f_a", "f_b").alias("score"),
    )
    three = (
        triples.join(pairs.withColumnRenamed("n", "f_ab"), ["a", "b"])
        .join(pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("f_bc")), ["b", "c"])
        .join(word("a", "lang"), "a").join(word("b"), "b").join(word("c"), "c")
        .withColumn("first", score("n", "f_a", "f_bc")).withColumn("second", score("n", "f_ab", "f_c"))
    )
    early = F.col("first") <= F.col("second")
    three = three.select(
        "lang", F.concat_ws(" ", "word_a", "word_b", "word_c").alias("phrase"), F.col("n").alias("count"),
        F.when(early, F.col("f_a")).otherwise(F.col("f_ab")).alias("l"),
        F.when(early, F.col("f_bc")).otherwise(F.col("f_c")).alias("r"), F.least("first", "second").alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("count"), "phrase")
    best = two.union(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(sums, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("count").alias("a"), "l", "r", "n", "score")

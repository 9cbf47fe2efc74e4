"""Manifest, collocations and packing against brute force, over odd rows, empty tables and further columns."""

import bisect
import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from conftest import DOCUMENTS, ODD, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyweave.llm import collocations, merkle, packing
from tallyweave.llm.byte_bpe import read_ranks

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def hashed(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return hashed("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([hashed(levels[-1][k:k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def brute_manifest(rows, changed):
    """Results by whole trees, each fold by hashing whole runs anew."""
    groups = defaultdict(list)
    for row in rows:
        groups[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf([row[c] for c in COLUMNS]), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        groups[source].sort(key=lambda x: x[:3])
        trees[source] = tree_of([x[2] for x in groups[source]])
    top = tree_of([trees[s][-1][0] for s in order])
    found = []
    for at, source in enumerate(order):
        for place, (_, _, own, row) in enumerate(groups[source]):
            digest, siblings = leaf([changed(row) if c == "text" else row[c] for c in COLUMNS]), []
            for levels, p in ((trees[source], place), (top, at)):
                for nodes in levels[:-1]:
                    run, slot = nodes[p // 16 * 16: p // 16 * 16 + 16], p % 16
                    siblings += run[:slot] + run[slot + 1:]
                    digest, p = hashed([*run[:slot], digest, *run[slot + 1:]]), p // 16
            root = top[-1][0]
            found.append((row["doc_id"], own, trees[source][-1][0], root, hashed(siblings), digest, digest == root))
    return Counter(found)


def manifest_of(docs):
    tree = merkle.manifest(docs, "doc_id", "source", COLUMNS, {"text": F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))})
    return Counter(tuple(r) for r in merkle.folded(tree).collect())


def lowered(row):
    return row["text"].lower() if row["text"] is not None and row["doc_id"] is not None and row["doc_id"] % 3 == 0 else row["text"]


@pytest.mark.parametrize("size", [0, 1, 16, 17, 257, 600])
def test_manifest_equals_whole_trees(spark, documents, size):
    docs = documents([(k, f"Text {k} é", f"s{k % 3}" if k < 30 else "hot") for k in range(size)])
    assert manifest_of(docs) == brute_manifest(docs.collect(), lowered)


def test_manifest_of_odd_rows_and_many_groups(spark, documents):
    docs = documents(ODD + [(k, "One Row", f"host{k}") for k in range(300)]).withColumn("_at", F.lit(7)).withColumn("path", F.lit("x"))
    assert manifest_of(docs) == brute_manifest(docs.collect(), lowered)


def test_every_kept_state_resumes_to_the_whole_hash():
    children = [hashed([str(k)]) for k in range(16)]
    parent = merkle.Parent(children)
    assert parent.digest == hashed(children)
    for slot in range(16):
        assert parent.resumed(slot, "f" * 64) == hashed([*children[:slot], "f" * 64, *children[slot + 1:]])


def brute_phrases(rows, least, top):
    counts = defaultdict(Counter)
    for row in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), row["text"] or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            own = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts[row["lang"] or "und"].update(tuple(own[i:i + k]) for i in range(len(own) - k + 1))
    found = []
    for lang, f in counts.items():
        n, scored = sum(c for p, c in f.items() if len(p) == 1), []
        often = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        for phrase, a in often.items():
            longer = [c for p, c in often.items() if len(p) == 3 and phrase in (p[:2], p[1:])] if len(phrase) == 2 else []
            if any(100 * c >= 50 * a for c in longer):
                continue
            parts = [(f[phrase[:k]], f[phrase[k:]]) for k in range(1, len(phrase))]
            value, at = min((1000000 * a * a // (x * y), k) for k, (x, y) in enumerate(parts))
            scored.append((-value, -a, " ".join(phrase).encode(), phrase, parts[at]))
        for rank, (value, a, _, phrase, (x, y)) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, " ".join(phrase), -a, x, y, n, -value))
    return sorted(found)


@pytest.mark.parametrize("budget", [collocations.BUDGET, 40, 5])
def test_phrases_equal_counting_all(spark, monkeypatch, budget):
    monkeypatch.setattr(collocations, "BLOCK_CHARS", 2000)
    chance = random.Random(3)
    texts = [" ".join(chance.choice(["the", "of", "a", "New", "york", "CITY", "x.", "y,z", "\n", "\t", "é", "\x01"]) for _ in range(120)) for _ in range(60)]
    rows = [(k, t, chance.choice(["en", "de", None]), "s", 1) for k, t in enumerate(texts)] + [(i, t, "und", s, 1) for i, t, s in ODD]
    docs = spark.createDataFrame(rows, DOCUMENTS).withColumn("a", F.lit(1)).withColumn("phrase", F.lit("p")).repartition(3)
    found = collocations.collocations(docs, least=4, top=30, budget=budget)
    assert sorted(map(tuple, found.collect())) == brute_phrases(docs.collect(), 4, 30)


def test_no_phrases_without_texts(spark, documents):
    assert collocations.collocations(documents([])).collect() == []
    assert collocations.collocations(documents([(1, None, None), (2, "", "s"), (3, "too rare a phrase", "s")])).collect() == []


def test_distinct_rows_of_large_numbers():
    import numpy as np
    big = [np.array([1 << 40, 5, 1 << 40, 5]), np.array([2, 1, 2, 1 << 39]), np.array([0, 3, 0, 3])]
    rows, counts = collocations.distinct(big, np.array([2, 1, 5, 1]))
    assert [r.tolist() for r in rows] == [[5, 5, 1 << 40], [1, 1 << 39, 2], [3, 3, 0]] and counts.tolist() == [1, 1, 7]
    assert collocations.unpack(collocations.pack(big[0])).tolist() == big[0].tolist()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encode(spark):
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return packing.encoder(spark, *paths, public_tokenizers.PATTERN)


def test_ids_equal_those_of_the_tokenizer(tokenizer):
    ranks = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    texts, chance = packing.Texts(tokenizer, ranks), random.Random(5)
    odd = ["", "  ", "<|endoftext|> a", " " * 200000, "x" * 20000, "a　 b\x85 \x1f", "日本 語 🙂", "don't 's"]
    odd += ["".join(chance.choice("aé \n\t'1!\x1c日ſ≠🙂") for _ in range(chance.randint(0, 30))) for _ in range(3000)]
    for text in odd:
        assert texts(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text[:50])


def best_fit(lengths, capacity):
    """Rooms left when each length, from long to short, goes to the tightest open bin."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        bisect.insort(rooms, (rooms.pop(at) if at < len(rooms) else capacity) - length)
    return rooms


def filled(parts, capacity):
    """Rooms left by (sequence, offset, length) rows; places must be gapless."""
    by = defaultdict(list)
    for sequence, offset, length in parts:
        by[sequence].append((offset, length))
    rooms = []
    for own in by.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
        rooms.append(capacity - end)
    return sorted(rooms)


def test_plan_equals_best_fit_decreasing():
    chance = random.Random(7)
    for _ in range(60):
        capacity = chance.choice([5, 16, 64, 1024])
        counts = {chance.randint(1, capacity): chance.randint(1, 40) for _ in range(chance.randint(0, 20))}
        parts, own = [], defaultdict(list)
        for run in packing.plan(counts, capacity):
            own[run.length].append(run)
        for length, runs in own.items():
            for number in range(counts[length]):
                run = [r for r in runs if r.first <= number][-1]
                bins, turn = divmod(number - run.first, run.times)
                parts.append((run.sequence + bins, run.offset + turn * length, length))
        assert filled(parts, capacity) == best_fit([n for n, c in counts.items() for _ in range(c)], capacity)


def test_packing_of_odd_rows(spark, documents, tokenizer):
    docs = documents(ODD + [(100 + k, words(k % 40), "s") for k in range(200)]).withColumn("length", F.lit(1)).withColumn("piece", F.lit("x"))
    cut = packing.pieces(docs.repartition(3), encode(spark), end=2, capacity=64)
    rows = packing.packed(cut, 64).collect()
    expected, lengths = Counter(), []
    for row in docs.collect():
        ids = [*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 2]
        bounds = [0, *range(len(ids) % 64 or 64, len(ids) + 1, 64)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected[row["doc_id"], piece, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
            lengths.append(b - a)
    assert Counter(tuple(r)[:5] for r in rows) == expected
    assert filled([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 64) == best_fit(lengths, 64)
    made = packing.sequences(spark.createDataFrame(rows, packing.packed(cut, 64).schema)).collect()
    assert sum(r["length"] for r in made) == sum(lengths) and max(r["length"] for r in made) <= 64


def test_nothing_to_pack(spark, documents):
    assert packing.packed(packing.pieces(documents([]), encode(spark), 2, 64), 64).collect() == []

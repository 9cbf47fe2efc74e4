import hashlib
import math
import random
import re
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from conftest import ODD, words
from pyspark.sql import functions as F

from tallyweave.llm import byte_bpe, lm_score, token_counts, training_order
from tallyweave.llm.common import remainder
from tallyweave.llm.pieces import START, Lattice, best_counts, expected, marginals, read_vocabulary
from tallyweave.llm.queries import PIECES, RANKS

VOCABULARY = read_vocabulary(PIECES)


@cache
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def fuzz(count=150):
    pick = random.Random(5)
    signs = "ab Zé \n\t\r\x0b\x1c\x1d\x85   　'sdtlvem1²٣日👩‍.,!#_-́ñ"
    return [(1000 + k, "".join(pick.choice(signs) for _ in range(pick.randint(1, 60))), "f") for k in range(count)]


def test_runs_hold_whole_matches():
    one, run = regex.compile(public_tokenizers.PATTERN).findall, re.compile(byte_bpe.RUNS).findall
    for _, text, _ in ODD + fuzz(20_000):
        assert [w for r in run(text or "") for w in one(r)] == one(text or "")
    spaces = re.compile(f"[{byte_bpe.SPACES}]").match
    assert all(bool(spaces(c)) == bool(regex.match(r"\s", c)) for c in map(chr, range(0x110000)))


@pytest.mark.parametrize("runs", [None, byte_bpe.RUNS])
def test_bpe_equals_the_library(documents, runs):
    rows = ODD + fuzz()
    docs = documents(rows).withColumn("ids", F.lit("clash")).repartition(3)
    found = byte_bpe.digests(docs, byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN, runs).collect()
    want = []
    for key, text, _ in rows:
        ids = encoding().encode_ordinary(text or "")
        want.append((key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, found), key=order) == sorted(want, key=order)


def test_bpe_without_rows(documents):
    assert byte_bpe.digests(documents([]), byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN, byte_bpe.RUNS).collect() == []


def segmentations(text):
    """All ways through a short word, as (log probability, tokens)."""
    lattice = Lattice(VOCABULARY)
    found = {0: [(0.0, 0)]}
    for end in range(1, len(text) + 1):
        found[end] = [
            (p + score, n + (len(piece) if isinstance(piece, bytes) else 1))
            for start, piece, score in lattice.arcs(text, end) for p, n in found[start]
        ]
    return found[len(text)]


def test_lattice_walks_equal_brute_force():
    pick = random.Random(3)
    made = sorted({"".join(pick.choice("theandiñ日x") for _ in range(pick.randint(1, 8))).encode() for _ in range(120)})
    lattice, every = Lattice(VOCABULARY), [segmentations(START + w.decode()) for w in made]
    assert best_counts(made, lattice) == [min((-p, n) for p, n in x)[1] for x in every]
    total = [math.log(math.fsum(math.exp(p) for p, _ in x)) for x in every]
    assert marginals(made, lattice) == pytest.approx(total)
    counts = [1 + k % 4 for k in range(len(made))]
    tokens = sum(c * math.fsum(math.exp(p - t) * n for p, n in x) for c, x, t in zip(counts, every, total))
    assert sum(expected(made, counts, lattice)) == pytest.approx(tokens)


def test_token_counts(documents):
    docs = documents(ODD).withColumn("n_tokens", F.lit("clash"))
    lattice = Lattice(VOCABULARY)
    found = token_counts.token_counts(docs, VOCABULARY, ["doc_id"]).collect()
    want = []
    for key, text, _ in ODD:
        own = (text or "").encode().split()
        want.append((key, len(own), sum(best_counts([w], lattice)[0] for w in own)))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert token_counts.token_counts(documents([]), VOCABULARY, ["doc_id"]).collect() == []


def test_language_model(documents):
    rows = ODD + [(100 + k, words(30, k % 7) + " The THE the", "s") for k in range(40)]
    held = remainder(F.col("doc_id"), 7) == 2
    docs = documents(rows).withColumn("held_out", held).withColumn("score", F.lit("clash"))
    found = lm_score.score(docs, ~F.col("held_out"), VOCABULARY, ["doc_id", "held_out"]).collect()
    texts = {r[0]: (r[1] or "") for r in rows}
    cut_up = lambda t: t.encode().lower().split()
    training = [(r[1] or "", r[0]) for r in rows]
    flags = {r["doc_id"]: r["held_out"] for r in found}
    counts, texts_learnt = {}, 0
    for text, key in training:
        if not flags[key]:
            texts_learnt += 1
            for w in cut_up(text):
                counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()) + texts_learnt, len(counts) + 1
    assert len(found) == len(rows) and {r["train_tokens"] for r in found} == {total}
    for r in found:
        own = cut_up(texts[r["doc_id"]])
        seen = [counts.get(w, 0) for w in own] + [texts_learnt]
        assert (r["n_tokens"], r["n_known"]) == (len(own) + 1, sum(c > 0 for c in seen))
        assert r["base_score"] == pytest.approx(sum(math.log10((c + 1) / (total + distinct + 1)) for c in seen))
        assert r["score"] < 0
    # A text of known words is likelier than one of as many unknown ones.
    value = {r["doc_id"]: r["score"] / r["n_tokens"] for r in found}
    assert value[100] > value[7]


def test_language_model_without_training(documents):
    docs = documents(ODD)
    found = lm_score.score(docs, F.lit(None).cast("boolean"), VOCABULARY, ["doc_id"]).collect()
    assert len(found) == len(ODD) and all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in found)
    assert lm_score.score(documents([]), F.lit(True), VOCABULARY, ["doc_id"]).collect() == []


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 63, 64, 65, 1000])
def test_permutation(count):
    placed = training_order.permuted(np.arange(count), count, 11)
    assert sorted(placed.tolist()) == list(range(count))
    assert training_order.permuted(placed, count, 11, back=True).tolist() == list(range(count))
    if count > 60:
        assert placed.tolist() != training_order.permuted(np.arange(count), count, 12).tolist()


def test_training_order_round_trip(spark, documents, tmp_path):
    rows, ranks = ODD + fuzz(20), byte_bpe.read_ranks(RANKS)
    encoder = byte_bpe.encoder(spark, ranks, public_tokenizers.PATTERN)
    found = training_order.sequences(documents(rows).withColumn("task", F.lit("clash")).repartition(3), encoder, len(ranks), length=64)
    stored = str(tmp_path / "shards")
    training_order.shards(found, key=3, shard=8).write.parquet(stored)
    shards = spark.read.parquet(stored).orderBy("shard").collect()
    assert [r["first_slot"] for r in shards] == [8 * k for k in range(len(shards))]
    assert {r["n_sequences"] for r in shards[:-1]} == {8} and {r["stride"] for r in shards} == {128}
    slots = np.frombuffer(b"".join(r["payload"] for r in shards), "<u2").reshape(-1, 64)
    stream = slots[training_order.permuted(np.arange(len(slots)), len(slots), 3)].ravel().tolist()
    texts, own = [], []
    for token in stream:
        if token == len(ranks):
            texts.append(tuple(own))
            own = []
        else:
            own.append(token)
    want = [tuple(encoding().encode_ordinary(t or "")) for _, t, _ in rows]
    assert sorted(x for x in texts if x) == sorted(x for x in want if x) and len(texts) >= len(want) and not own
    for start in (-1, 0, 7, 8, 13, len(slots) - 1, len(slots), 10_000):
        later = training_order.read_from(spark.read.parquet(stored), start, shard=8).orderBy("slot").collect()
        assert [r["slot"] for r in later] == list(range(max(0, start), len(slots)))
        assert [r["tokens"] for r in later] == [x.tobytes() for x in slots[max(0, start):]]


def test_reading_on_is_a_filter_of_the_scan(spark, tmp_path, capsys):
    stored = str(tmp_path / "shards")
    spark.sql("select 0L as shard, 0L as first_slot, 2 as n_sequences, 1 as stride, X'0102' as payload").write.parquet(stored)
    training_order.read_from(spark.read.parquet(stored), 1000).explain("formatted")
    assert "GreaterThanOrEqual(shard,3)" in capsys.readouterr().out


def test_training_order_without_rows(spark, documents):
    found = training_order.sequences(documents([]), byte_bpe.encoder(spark, byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN), 50256)
    assert training_order.shards(found, key=3).collect() == []

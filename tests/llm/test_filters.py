import random

import numpy as np
import pytest
from conftest import ODD, words
from pyspark.sql import functions as F

import corpus_pipeline
from tallyweave.llm import decontaminate, line_dedup, quality_rules, quality_trees, toxicity

BOILERPLATE = "all rights reserved by the owner"


def test_lines_on_many_sites_stay_once(documents):
    rows = [(k, f"own line {k} here\n{BOILERPLATE}\nshort\n\nshort", f"site{k % 12}") for k in range(30)]
    rows += [(100, f"{BOILERPLATE}\n{BOILERPLATE}", None), (101, BOILERPLATE.upper(), "site1")] + ODD
    docs = documents(rows).withColumn("_gone", F.lit("clash"))
    found = line_dedup.without_boilerplate(docs, removed="n_removed", least_words=3).collect()
    by_key = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert len(found) == len(rows) and found[0]["_gone"] == "clash"
    assert by_key[0]["text"] == rows[0][1] or by_key[0]["n_removed"] == 0
    for k in range(9, 30):
        assert by_key[k]["text"] == f"own line {k} here\nshort\n\nshort" and by_key[k]["n_removed"] == 1
    assert (by_key[100]["text"], by_key[100]["n_removed"]) == ("", 2) and by_key[101]["text"] == BOILERPLATE.upper()
    texts = {(i, t) for i, t, _ in rows}
    assert all((r["doc_id"], r["text"]) in texts for r in found if r["n_removed"] == 0)


@pytest.mark.parametrize(("sites", "gone"), [(9, 0), (10, 9), (11, 10)])
def test_lines_near_the_threshold_are_counted(documents, sites, gone):
    rows = [(k, BOILERPLATE, f"s{k}") for k in range(sites)]
    assert line_dedup.without_boilerplate(documents(rows)).where("text = ''").count() == gone


def test_short_lines_go_in_the_pipeline(spark, documents):
    short = ["Les.", "And ornd.", "利用規約とプライバシーポリシー"]
    rows = [(k, "\n".join([f"own line {k} here", *short, "", " \t", "Few." if k < 9 else "own"]), f"s{k}") for k in range(12)]
    found = {r["doc_id"]: r for r in corpus_pipeline.without_boilerplate(spark, documents(rows), "").collect()}
    assert found[0]["text"] == rows[0][1]
    for k in range(1, 12):
        left = "\n".join([f"own line {k} here", "", " \t", "Few." if k < 9 else "own"])
        assert (found[k]["text"], found[k]["n_chars"]) == (left, len(left))


def test_short_lines_go_by_default(documents):
    rows = [(k, f"own line {k} here\nLes.\n\n \t\nLes.", f"s{k}") for k in range(12)]
    found = {r["doc_id"]: r["text"] for r in line_dedup.without_boilerplate(documents(rows)).collect()}
    assert found[0] == "own line 0 here\nLes.\n\n \t"
    assert all(found[k] == f"own line {k} here\n\n \t" for k in range(1, 12))


def test_lines_without_rows(documents):
    assert line_dedup.without_boilerplate(documents([])).collect() == []


def test_items_inside_documents(spark, documents):
    item = words(30, 500)
    almost = words(27, 500)         # 23 of 26 shingles
    half = words(15, 500)
    rows = [
        (1, words(9000) + " " + item.upper().replace(" ", ", ") + " " + words(5000, 20000), "s"), (2, almost, "s"), (3, half, "s"),
        (4, words(40, 90000), "s"), (4, words(40, 90000), "s"), (5, item, "s"), (5, item, "s"),
    ] + ODD
    items = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "too short an item"), (None, words(8, 600000))], "item_id int, text string")
    docs = documents(rows).withColumn("_item", F.lit("clash"))
    found = {(r["_key"], r["_item"]) for r in decontaminate.contained(docs, items).collect()}
    inside = {(k, i) for k in (1, 2, 5) for i in (1, 2)}
    assert found == inside      # the very long text holds them too
    kept = decontaminate.decontaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in rows if (r[0], r[1]) not in {(1, rows[0][1]), (2, almost), (5, item), (5, words(20000))})
    assert decontaminate.contained(documents([]), items).collect() == []
    assert decontaminate.contained(docs, items.limit(0)).collect() == []


def test_sketches_miss_nothing(spark):
    """Any subset of 80 % of an item's shingles holds one of its values."""
    pick = random.Random(2)
    tests = spark.createDataFrame([(n, [f"s{n}_{k}" for k in range(n)], n) for n in (1, 2, 4, 5, 9, 10, 11, 26, 40)], "_item int, _shingles array<string>, _n int")
    values = decontaminate.sketches(tests).groupBy("_item").agg(F.collect_set("_hash").alias("v")).collect()
    held = tests.select("_item", F.transform("_shingles", lambda s: F.xxhash64(s)).alias("h")).collect()
    hashes = {r["_item"]: r["h"] for r in held}
    for r in values:
        own = hashes[r["_item"]]
        for _ in range(200):
            assert set(pick.sample(own, -(-len(own) * 80 // 100))) & set(r["v"])


def windows(text):
    """Brute force of the words in repeated windows."""
    own = (text or "").split(" ")
    seen = [tuple(own[k:k + 8]) for k in range(len(own) - 7)]
    return len({k + j for k, w in enumerate(seen) if seen.count(w) > 1 for j in range(8)})


def test_repeated_words_equal_brute_force():
    pick = random.Random(4)
    for _ in range(60):
        text = " ".join(pick.choice("ab") for _ in range(pick.randint(0, 60)))
        assert quality_rules.repeated_words(text.encode().split()) == windows(text)
    assert quality_rules.counted("a b\n\nx#y\na b\n a b") == (7, 9, 1, 4, 1, 0)


def test_hosts_fall_with_their_documents(documents):
    good, bad = words(40), "too short"
    rows = [(k, words(40, k), "good") for k in range(60)] + [(100, bad, "good")]
    rows += [(200 + k, bad, "bad") for k in range(50)] + [(300, good, "bad"), (301, good, None), (302, good, "new")] + ODD
    found = {r["doc_id"]: r for r in quality_rules.judged(documents(rows).withColumn("_host", F.lit("clash"))).collect()}
    assert found[0]["kept"] and not found[100]["kept"] and not found[100]["host_rate"] > 0.5
    assert not found[300]["kept"] and not found[300]["base_failed"] and found[300]["host_rate"] > 0.5
    assert found[301]["kept"] and found[301]["host_rate"] is None
    assert 0 < found[302]["host_rate"] < 0.5 and found[302]["kept"]
    assert not found[1]["kept"] and found[1]["n_words"] == 0 and found[5]["n_words"] == 20000
    assert quality_rules.judged(documents([])).collect() == []


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, quality int")


def test_all_telling_words_are_kept():
    pick = random.Random(5)
    word = lambda first: first + bytes(pick.choice(b"abcdefghijklm") for _ in range(8))
    telling, plain = sorted({word(b"z") for _ in range(1000)}), [word(b"y") for _ in range(300)]
    passage = lambda own: b" " + b" ".join([*own, *pick.sample(plain, 3)])
    toxic, ordinary = [passage([w]) for w in telling for _ in range(40)], [passage([]) for _ in range(40000)]
    content = toxicity.telling(toxic, ordinary)
    assert sorted(content.split()) == telling
    distances = toxicity.Distances(toxicity.Model(b"".join(ordinary)[-toxicity.ORDINARY_BYTES:], content, [], 0.5))
    missed = [w for w in telling if distances[w] == 0]
    assert not missed, len(missed)
    assert sum(distances[w] > 0 for w in plain) == 0


def test_toxic_words_are_learnt(spark, documents):
    pick = random.Random(1)
    syllables = ["ta", "mo", "ri", "len", "sho", "ba", "ker", "du", "fin", "wo"]
    word = lambda: "".join(pick.choice(syllables) for _ in range(pick.randint(1, 4)))
    rows, marks = [], []
    for k in range(700):
        own, toxic = [word() for _ in range(60)], k % 4 == 0
        if toxic:
            for at in pick.sample(range(60), 4):
                own[at] = pick.choice(["grobian", "flegelhaft", "zwrrkopf"])
        rows.append((k, " ".join(own), "s"))
        marks.append((k, int(toxic), 1))
    rows, marks = rows + [(-1, None, "s"), (-2, "", "s"), (-3, "Grobian! " + words(3000), "s"), (None, "grobian", "s")], marks + [(0, None, None), (None, 1, 1), (1, 0, 1)]
    docs = documents(rows).withColumn("score", F.lit("clash"))
    model = toxicity.train(docs, labels(spark, marks), "toxic", F.col("doc_id") % 5 != 0)
    assert b"grobian" in model.toxic
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(found) == len(rows) and all(0 <= s <= 1 for s in found.values())
    held = [k for k in range(700) if k % 5 == 0]
    right = sum((found[k] >= 0.5) == (k % 4 == 0) for k in held)
    assert right >= 0.95 * len(held)


def test_toxicity_without_labels(spark, documents):
    docs = documents(ODD)
    model = toxicity.train(docs, labels(spark, [(1, None, None)]), "toxic", F.lit(True))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0}
    one = toxicity.train(docs, labels(spark, [(4, 1, 1), (5, 1, 1)]), "toxic", F.lit(True))
    assert {r["score"] for r in toxicity.score(docs, one).collect()} == {1.0}
    assert toxicity.score(documents([]), model).collect() == []


def test_trees_fit_and_flatten():
    pick = np.random.default_rng(0)
    rows = pick.random((4000, len(quality_trees.STATISTICS)))
    truth = ((rows[:, 0] > 0.5) ^ (rows[:, 3] > 0.3)).astype(int)
    trees = quality_trees.fit(rows[:3000], truth[:3000])
    assert ((trees.margin(rows[3000:]) > 0) == truth[3000:]).mean() > 0.97
    # Vectorised traversal gives what walking each tree row by row gives.
    for row in rows[:20]:
        total = trees.base
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += value[node - len(feature)]
        assert trees.margin(row[None])[0] == pytest.approx(total)


def test_quality_scores(spark, documents):
    rows = [(k, words(50, k) if k % 3 else "JUNK!! " * 40, "s") for k in range(300)] + ODD
    docs = documents(rows).withColumn("score", F.lit("clash"))
    known = labels(spark, [(k, 0, int(bool(k % 3))) for k in range(300)] + [(None, 1, 1), (7, None, None)])
    trees = quality_trees.train(docs, known, "quality", F.col("doc_id") % 5 != 0)
    found = [r for r in quality_trees.score(docs, trees).collect()]
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    assert all((r["score"] >= 0.3) == bool(r["doc_id"] % 3) for r in found if r["doc_id"] and r["doc_id"] % 5 == 0 and r["doc_id"] > 20)
    none = quality_trees.train(docs, known.limit(0), "quality", F.lit(True))
    assert {r["score"] for r in quality_trees.score(docs, none).collect()} == {0.5}
    assert quality_trees.score(documents([]), trees).collect() == []

import random
import re

from conftest import ODD, words
from pyspark.sql import functions as F

import corpus_pipeline
from tallyweave.llm import jaccard_join
from tallyweave.llm.components import connected


def brute(rows):
    """Classes, links between them and groups, from all pairs."""
    sets, links = {}, {}
    for key, text, _ in rows:
        own = re.findall(r"[^\W_]+", (text or "").lower())
        size = min(5, len(own))
        if size:
            sets.setdefault(frozenset(tuple(own[k:k + size]) for k in range(len(own) - size + 1)), []).append(key)
    nodes = list(sets)
    links = {n: [m for m in nodes if m != n and 100 * len(n & m) >= 80 * len(n | m)] for n in nodes}
    found = {}
    for n in nodes:
        reached, todo = {n}, [n]
        while todo:
            for m in links[todo.pop()]:
                if m not in reached:
                    reached.add(m)
                    todo.append(m)
        for key in sets[n]:
            found[key] = (min(sets[n]), len(links[n]), min(min(sets[m]) for m in reached))
    return found


def near_copies(count, seed, length=120, edits=6):
    pick = random.Random(seed)
    base = [f"b{seed}x{k}" for k in range(length)]
    made = []
    for _ in range(count):
        own = list(base)
        for at in pick.sample(range(length), pick.randint(0, edits)):
            own[at] = f"e{pick.random()}"
        made.append(" ".join(own))
    return made


def test_links_equal_brute_force(documents, monkeypatch):
    texts = near_copies(60, 1) + near_copies(25, 2) + [words(80, 1000 * k) for k in range(20)] + near_copies(1, 3, edits=0) * 9
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    want = brute(rows)
    odd = [(k + 1000 if k is not None else None, t, s) for k, t, s in ODD]
    docs = documents(rows + odd).withColumn("node", F.lit("clash"))
    for block in (512, 16):     # also with large buckets dealt out in blocks
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        found = jaccard_join.linked(docs).collect()
        assert len(found) == len(rows) + len(odd)
        got = {r["_key"]: (r["first"]["_key"], r["n_links"], r["leader"]["_key"]) for r in found}
        wrong = [k for k in want if got[k] != want[k]]
        assert len(wrong) <= 1, [(k, got[k], want[k]) for k in wrong]      # a link at 0.8 is missed once in a thousand
        assert got[1001] == (1001, 0, 1001) and got[1003] == (1003, 0, 1003)


def test_one_row_of_a_group_stays(documents):
    texts = near_copies(30, 1, edits=2) + near_copies(1, 2) * 5 + [None, "", "", "..."]
    docs = documents([(k, t, "s") for k, t in enumerate(texts)] + [(30, texts[30], "s")])
    kept = jaccard_join.deduplicated(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 30, 35, 36, 37, 38]
    assert jaccard_join.deduplicated(documents([])).collect() == []


def test_bands_follow_the_recall():
    bands = jaccard_join.bands_for(0.8, 0.999, 6)
    assert 1 - (1 - 0.8**6) ** bands >= 0.999 > 1 - (1 - 0.8**6) ** (bands - 1)


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 200), (7, 7)]
    found = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_pipeline_stages(spark, documents, tmp_path):
    item = words(30, 70000)
    rows = [(k, words(60, 100 * k), f"s{k % 20}") for k in range(40)] + [(50 + k, t, "s1") for k, t in enumerate(near_copies(6, 1, edits=2))]
    rows += [(60, words(50, 80000) + " " + item, "s2"), (61, None, None), (None, "a text without an id", "s3")]
    folder = str(tmp_path / "tables")
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 0, 1), (2, None, 1)], "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "byte_bpe"]
    found = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert found == {*range(40), 50, 61, None}
    empty = documents([])
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, empty, folder)
        assert made.collect() == [] and (name == "byte_bpe" or made.columns == empty.columns)

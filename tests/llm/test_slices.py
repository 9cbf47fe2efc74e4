import pandas as pd

import corpus_pipeline
from tallyweave.llm import jaccard_join


def test_rows_are_hashed_a_few_at_a_time(monkeypatch):
    monkeypatch.setattr(jaccard_join, "ROWS_AT_ONCE", 3)
    frame = pd.DataFrame({"node": list("abcdefgh"), "bands": 0, "size": 1, "_text": [f"word{k} and more" for k in range(8)]})
    found = list(jaccard_join._with_grams(iter([frame])))
    assert [len(x) for x in found] == [3, 3, 2]
    whole = pd.concat(found, ignore_index=True)
    own = jaccard_join.Hashes()
    assert list(whole["node"]) == list("abcdefgh")
    assert list(whole["grams"]) == [jaccard_join.grams(f"word{k} and more", own).tobytes() for k in range(8)]


def test_words_are_forgotten_in_time(monkeypatch):
    monkeypatch.setattr(jaccard_join, "REMEMBERED", 10)
    hashes = jaccard_join.Hashes()
    found = [hashes[f"word{k}"] for k in range(95)]
    assert len(hashes) <= 10 and found == [jaccard_join.xxhash.xxh3_64_intdigest(b"word%d" % k) for k in range(95)]


def test_stages_get_few_rows_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "AT_ONCE", 7)
    before = spark.conf.get(corpus_pipeline.BATCH)

    @corpus_pipeline.in_small_batches
    def stage(spark, docs, folder):
        return docs.mapInPandas(lambda frames: (pd.DataFrame({"n": [len(x)]}) for x in frames), "n long")

    try:
        sizes = [r.n for r in stage(spark, spark.range(0, 100, 1, 2), "").collect()]
        assert sum(sizes) == 100 and max(sizes) == 7
        assert all(getattr(run, "__wrapped__", None) for name, run in corpus_pipeline.STAGES if name in ("toxicity", "jaccard_join", "byte_bpe"))
    finally:
        spark.conf.set(corpus_pipeline.BATCH, before)

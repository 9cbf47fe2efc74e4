import os

import pytest
from pyspark.sql import types as T

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.IntegerType()),
])


@pytest.fixture(scope="session", autouse=True)
def importable(spark, tmp_path_factory):
    spark.sparkContext.environment["PYTHONPATH"] = REPO
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


@pytest.fixture
def documents(spark):
    """Makes documents of (doc_id, text, source) triples."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCUMENTS)

    return make


def words(count, start=0):
    return " ".join(f"w{k}" for k in range(start, start + count))


#: Null and empty texts, a null id and source, a repeated row, a very long text, odd characters.
ODD = [
    (None, "a text without an id, of a few words", "s1"), (1, None, "s1"), (2, "", None), (3, " \n\t ", "s2"),
    (4, "twice twice", "s2"), (4, "twice twice", "s2"), (5, words(20000), "s3"), (6, "x" * 50000, "s3"),
    (7, "naïve  日本語 \x00\x1f 👩‍👩‍👧 don't  stop\r\n", "s4"), (8, "#### $$$ || <>", None),
]

"""Row identities for operators that take texts apart and bring the parts back to their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wrapped(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows as a struct ``_row`` beside their identity, so that no name can clash.

    The identity is the key and two hashes of key and text. Rows that share all three are
    repeats and are treated alike.
    """
    names = F.struct(F.col(key), F.col(text))
    return docs.select(
        F.struct(*docs.columns).alias("_row"), F.col(key).alias("_key"), F.xxhash64(names).alias("_id"),
        F.hash(names).alias("_id2"), F.col(text).alias("_text"),
    )


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it in lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Columns of an identity.
IDENTITY = ("_key", "_id", "_id2")


def join_rows(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by identity; the hashes are never null and carry the shuffle."""
    other = right.withColumnsRenamed({c: f"{c}_of" for c in IDENTITY})
    on = [F.col("_id") == F.col("_id_of"), F.col("_id2") == F.col("_id2_of"), F.col("_key").eqNullSafe(F.col("_key_of"))]
    return left.join(other, on, how).drop(*(f"{c}_of" for c in IDENTITY))

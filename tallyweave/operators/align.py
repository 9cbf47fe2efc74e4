"""Bringing frames to one schema, and bag union."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T


def align(df: DataFrame, schema: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """Exactly the columns of ``schema`` in order.

    Values that do not cast become null, missing columns are null, other columns go.
    """
    present = set(df.columns)
    out = [
        (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in schema.fields
    ]
    return df.select(*out, *[F.col(k) for k in keep])


def union_aligned(frames: Iterable[DataFrame], schema: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """Bag union after alignment: the types are settled before, never by coercion."""
    keep = tuple(keep)
    return reduce(DataFrame.unionByName, [align(f, schema, keep) for f in frames])


def union_loose(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union of frames that may lack columns of one another."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

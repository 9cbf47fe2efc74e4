"""The upsert as a plan: typing, in-batch dedupe, key probe and merge. Nothing here writes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyweave.functions.times import epoch_seconds_time, text_time
from tallyweave.schemas import NOW, TargetColumn, TargetTable

INSERT, UPDATE, KEEP = "insert", "update", "keep"
UPDATED_AT = "updated_at"


def _typed(column: TargetColumn, kind: T.DataType) -> Column:
    value = F.col(column.name)
    if column.kind == "timestamp":
        if isinstance(kind, T.NumericType):
            return epoch_seconds_time(value)
        if isinstance(kind, T.StringType):
            return text_time(value)
    return value.try_cast(column.kind)


def _default(column: TargetColumn, now: Column) -> Column:
    value = now if column.default == NOW else F.lit(column.default)
    return value.cast(column.kind)


def to_target(df: DataFrame, table: TargetTable, now: Column, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of the target table in order and typed.

    Columns that are not in the target go; absent ones take their default. A null that is
    there stays null.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    out = [
        (_typed(c, present[c.name]) if c.name in present else _default(c, now)).alias(c.name)
        for c in table.columns
    ]
    return df.select(*out, *[F.col(k) for k in keep])


def breaks_required(df: DataFrame, table: TargetTable) -> Column:
    """Whether a row would put a null into a column that must not be null."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = [_typed(c, kinds[c.name]).isNull() for c in table.columns if not c.nullable and c.name in kinds and c.name != table.key]
    return reduce(Column.__or__, parts, F.lit(False))


def last_per_key(
    df: DataFrame, key: str, order_by: Sequence[str], drop_order: bool = False, versions: str | None = None,
    without: Sequence[str] = (),
) -> DataFrame:
    """The last row per key in the given order; rows without a key go.

    A hash of the whole row breaks remaining ties, so the choice never depends on how the
    data is partitioned. ``max_by`` is combined before the shuffle: a key that fills a third
    of the table costs its reducer one row per map task. ``versions`` names a column that is
    above 1 for keys with different rows. Columns in ``without`` take part in the choice only.
    """
    columns = [c for c in df.columns if not (drop_order and c in order_by)]
    order = F.struct(*[F.col(c) for c in order_by], F.xxhash64(*columns))
    content = F.xxhash64(*columns)
    columns = [c for c in columns if c not in without]
    rest = [c for c in columns if c != key]
    several = [F.when(F.max(content) == F.min(content), 1).otherwise(2).alias(versions)] if versions else []
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.struct(*rest), order).alias("_row"), *several)
        .select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in columns], *[versions][: len(several)])
    )


def last_version(df: DataFrame, key: str, order_by: Sequence[str], version: str, without: Sequence[str] = ()) -> DataFrame:
    """``last_per_key`` with the ``version_text`` of the rows it keeps in a column named ``version``.

    The same rows are chosen as if that text and ``without`` were columns of ``df``, but a row
    goes through the sorts and the shuffle once: its order columns are part of the row.
    """
    rest = [c for c in df.columns if c != key and c not in without and c not in order_by]
    hashed = F.xxhash64(*df.columns, version_text(df, order_by))
    places = {f"_order_{k}": c for k, c in enumerate(order_by)}
    row = F.struct(*[F.col(c).alias(n) for n, c in places.items()], hashed.alias("_hash"), *rest)
    last = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(row).alias("_row"))
    rows = last.select(key, *[F.col(f"_row.{n}").alias(c) for n, c in places.items() if c != key], *[F.col(f"_row.{c}").alias(c) for c in rest])
    return rows.select(*[c for c in df.columns if c not in without], version_text(rows, order_by).alias(version))


def version_text(df: DataFrame, order_by: Sequence[str]) -> Column:
    """The order columns of a row as one text that sorts as they do; nulls come first.

    A row keeps it, so that a later load can tell whether its own row is the newer one.
    """
    parts = []
    for name in order_by:
        kind, value = df.schema[name].dataType, F.col(name)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            kind, value = T.LongType(), F.unix_micros(value.cast("timestamp"))
        if isinstance(kind, T.IntegralType):
            value = F.lpad((value.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 20, "0")
        elif not isinstance(kind, T.StringType):
            raise ValueError(f"'{name}' ({kind.simpleString()}) gives no order that can be kept; use texts, whole numbers or times")
        parts.append(F.coalesce(value, F.lit("")))
    return F.concat_ws("\x01", *parts)


def existing_keys(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Keys of the batch that the target already has. Reads one column of each side."""
    return target.select(key).join(incoming.select(key), key, "left_semi")


def merge_plan(
    target: DataFrame,
    incoming: DataFrame,
    key: str,
    now: Column,
    given: Sequence[str] | None = None,
    join_on: Sequence[str] = (),
    version: str | None = None,
    how: str = "full_outer",
) -> DataFrame:
    """Target after the upsert, with ``_op`` in insert, update and keep.

    One full outer join on the key; both sides have one row per key. On a match every column
    is replaced, also by null, or only the ``given`` ones. ``updated_at`` becomes ``now``.
    ``version`` names a column: a row whose version is above that of the incoming one stays as
    it is; a null on either side says nothing, so the incoming row wins. A ``left`` join leaves
    new keys out.
    """
    keys = [*join_on, key]
    columns = target.columns
    old = target.withColumn("_old", F.lit(True)).alias("old")
    new = incoming.select(*columns).withColumn("_new", F.lit(True)).alias("new")
    is_old, matched = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    stale = F.coalesce(F.col(f"old.{version}") > F.col(f"new.{version}"), F.lit(False)) if version else F.lit(False)
    is_new = matched & ~stale

    def merged(name: str) -> Column:
        if name in keys:
            return F.col(name)
        old_value, new_value = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name == UPDATED_AT:
            return F.when(is_old & is_new, now.cast(target.schema[name].dataType)).when(
                is_new, new_value).otherwise(old_value).alias(name)
        if given is not None and name not in given:
            return F.when(is_old, old_value).otherwise(new_value).alias(name)
        return F.when(is_new, new_value).otherwise(old_value).alias(name)

    return old.join(new, keys, how).select(
        *[merged(c) for c in columns],
        F.when(is_old & is_new, UPDATE).when(is_new, INSERT).otherwise(KEEP).alias("_op"),
    )


def merge_counts(plan: DataFrame) -> DataFrame:
    """Rows inserted and updated by a merge plan; a match counts as updated, changed or not."""
    return plan.agg(
        F.count_if(F.col("_op") != KEEP).alias("rows_processed"),
        F.count_if(F.col("_op") == INSERT).alias("rows_inserted"),
        F.count_if(F.col("_op") == UPDATE).alias("rows_updated"),
    )

"""Checking raw JSON records against their entity, keeping what does not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave.functions.numbers import to_double
from tallyweave.functions.text import WHITE_SPACE
from tallyweave.functions.times import ISO_FORMAT, epoch_seconds_time, number_in, text_time
from tallyweave.schemas import ADDRESS_PARTS, BILLING, RawField, raw_fields, raw_schema

_NO_TAGS = "map<string,string>"


def _whole(text: Column) -> Column:
    """Integer text, or a number without a fraction."""
    number = to_double(text)
    return F.coalesce(text.try_cast("bigint"), F.when(number == F.rint(number), number.try_cast("bigint")))


def _raw_time(text: Column, source: str) -> Column:
    """Billing numbers are always seconds; CRM dates are always text."""
    if source != BILLING:
        return text_time(text)
    return F.coalesce(epoch_seconds_time(number_in(text)), text_time(text))


def _coerced(field: RawField, source: str) -> Column:
    value = F.col(f"_record.{field.name}")
    if field.kind in ("text", "address", "tags"):
        return value
    text = F.btrim(value, F.lit(WHITE_SPACE))
    if field.kind == "whole":
        return _whole(text)
    if field.kind == "number":
        return to_double(text)
    if field.kind == "flag":
        return text.try_cast("boolean")
    return F.date_format(_raw_time(text, source), ISO_FORMAT)


def _with_default(field: RawField, value: Column) -> Column:
    if field.kind == "tags":
        return F.coalesce(value, F.create_map().cast(_NO_TAGS))
    return value if field.default is None else F.coalesce(value, F.lit(field.default))


def _fault(field: RawField) -> Column:
    """What is wrong with one field, or null."""
    absent = F.col(f"_record.{field.name}").isNull()
    named = F.array_contains("_names", field.name)
    checks = F.when(F.lit(field.required) & absent & ~named, f"{field.name}: missing")
    if not field.optional:
        checks = checks.when(absent & named, f"{field.name}: null")
    if field.kind not in ("text", "address", "tags"):
        checks = checks.when(~absent & F.col(f"_value_{field.name}").isNull(), f"{field.name}: not a {field.kind}")
    return checks


def check_raw(df: DataFrame, json_col: str, source: str, entity: str) -> DataFrame:
    """Adds ``record``, ``is_schema_valid`` and ``schema_errors`` to rows of raw JSON text.

    A valid record is typed, has its defaults and only known fields. An invalid one keeps the
    fields as they came; ``json_col`` stays in every row. Fields that are unknown, such as
    ``attributes``, never reach ``record``.
    """
    source = source.lower()
    fields = raw_fields(source, entity)
    parsed = df.withColumns({
        "_record": F.from_json(json_col, raw_schema(source, entity)),
        "_names": F.coalesce(F.json_object_keys(json_col), F.array().cast("array<string>")),
    })
    # Coerced values get columns of their own: the checks and the record both need them.
    typed = parsed.withColumns({f"_value_{f.name}": _coerced(f, source) for f in fields})
    faults = F.array_compact(F.array(*[_fault(f) for f in fields]))
    checked = typed.withColumn("schema_errors", faults)
    sound = F.size("schema_errors") == 0
    record = F.struct(*[
        F.when(sound, _with_default(f, F.col(f"_value_{f.name}")).cast(_kind(f)))
        .otherwise(F.col(f"_record.{f.name}").cast(_kind(f))).alias(f.name)
        for f in fields
    ])
    return checked.select(*df.columns, record.alias("record"), sound.alias("is_schema_valid"), "schema_errors")


def _kind(field: RawField) -> str:
    """Landed form of a field: scalars that a later step casts again stay text."""
    if field.kind == "address":
        return "struct<" + ",".join(f"{p}:string" for p in ADDRESS_PARTS) + ">"
    return _NO_TAGS if field.kind == "tags" else "string"

"""Cleaning steps over named columns of a DataFrame. Absent columns are skipped.

A value that a later expression needs more than once gets a projection of its own: texts
first, then the numbers in them, then the results. Every value is computed once per row, the
generated code stays small, and all of it runs in one stage.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyweave.functions.numbers import amount_of, round2, to_double
from tallyweave.functions.text import DEFAULT_CURRENCY, WHITE_SPACE, currency_code, email_address, trim_blank
from tallyweave.functions.times import ISO_FORMAT, epoch_iso, number_in, time_of

_MOMENTS = (T.TimestampType, T.TimestampNTZType, T.DateType)


def clean(
    df: DataFrame,
    text: Iterable[str] = (),
    emails: Mapping[str, str] | None = None,
    currencies: Mapping[str, str] | None = None,
    times: Iterable[str] = (),
    amounts: Mapping[str, str] | None = None,
    cents: Mapping[str, str] | None = None,
    defaults: Mapping[str, Any] | None = None,
) -> DataFrame:
    """All cleaning steps of a table at once.

    ``emails``, ``amounts`` and ``cents`` map a column to the column that takes the result,
    ``currencies`` a column to its default. ``defaults`` go in before text is trimmed, so only
    an absent value gets one.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    columns = list(kinds)
    first: dict[str, Column] = {}
    second: dict[str, Column] = {}
    third: dict[str, Column] = {}

    def plain(name: str) -> Column:
        value = F.col(name) if name in kinds else F.lit(None)
        value = value.cast("string")
        return F.coalesce(value, F.lit(defaults[name])) if defaults and name in defaults else value

    def trimmed(name: str) -> Column:
        """Trimmed text, from a projection of its own."""
        first[f"_text_{name}"] = F.btrim(plain(name), F.lit(WHITE_SPACE))
        return F.col(f"_text_{name}")

    def number(name: str) -> Column:
        return F.col(name).cast("double") if isinstance(kinds[name], T.NumericType) else to_double(trimmed(name))

    for name in text:
        if name in kinds:
            first[name] = trim_blank(plain(name))
    for name, target in (emails or {}).items():
        if name in kinds:
            first[target] = email_address(plain(name))
    for name, default in (currencies or {}).items():
        first[name] = currency_code(plain(name), default)
    for name in times:
        if name not in kinds:
            continue
        if isinstance(kinds[name], T.NumericType):
            third[name] = epoch_iso(F.col(name))
        elif isinstance(kinds[name], _MOMENTS):
            third[name] = F.date_format(F.col(name), ISO_FORMAT)
        else:
            second[f"_number_{name}"] = number_in(trimmed(name))
            third[name] = F.date_format(time_of(F.col(f"_number_{name}"), F.col(f"_text_{name}")), ISO_FORMAT)
    for wanted, in_cents in ((amounts, False), (cents, True)):
        for name, target in (wanted or {}).items():
            if name in kinds:
                second[f"_number_{name}"] = amount_of(number(name), in_cents)
                third[target] = round2(F.col(f"_number_{name}"))

    for step in (first, second, third):
        if step:
            df = df.withColumns(step)
    for name in (*first, *third):
        if name not in columns and not name.startswith("_text_"):
            columns.append(name)
    return df.select(*columns) if second else df


def clean_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim text and turn blanks into null, by default in every string column."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return clean(df, text=columns)


def normalize_emails(df: DataFrame, email_col: str = "email", target_col: str | None = None) -> DataFrame:
    return clean(df, emails={email_col: target_col or email_col})


def standardize_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """ISO text in place of numbers, numeric texts, date texts and timestamps."""
    return clean(df, times=columns)


def standardize_amounts(
    df: DataFrame, amount_col: str, in_cents: bool = False, target_col: str | None = None
) -> DataFrame:
    """Amounts in units with two decimals."""
    wanted = {amount_col: target_col or amount_col}
    return clean(df, cents=wanted) if in_cents else clean(df, amounts=wanted)


def standardize_currency(
    df: DataFrame, currency_col: str = "currency", default: str = DEFAULT_CURRENCY
) -> DataFrame:
    """Upper-case codes with a default; the column is added when it is not there."""
    return clean(df, currencies={currency_col: default})


def impute_nulls(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace nulls only; NaN stays, which ``na.fill`` would replace too."""
    there = set(df.columns)
    changed = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in there}
    return df.withColumns(changed) if changed else df

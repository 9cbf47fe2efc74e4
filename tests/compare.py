"""Comparing a registered query with its SQL on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.sql(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value)
    return str(value)


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in data)


def difference(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    answer = connection.sql(sql)
    if sorted(frame.columns) != sorted(answer.columns):
        return f"columns {sorted(frame.columns)} against {sorted(answer.columns)}"
    ours, theirs = rows(frame.columns, frame.collect()), rows(answer.columns, answer.fetchall())
    if ours == theirs:
        return None
    return (f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only ours {list((ours - theirs).items())[:2]}; only theirs {list((theirs - ours).items())[:2]}")

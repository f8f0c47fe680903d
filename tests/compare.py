"""Run catalog queries and their SQL twins on the same tables and compare them row by row."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


def kinds(rows: list[tuple]) -> list[set]:
    return [{type(v).__name__ for v in column if v is not None} for column in zip(*rows)] if rows else []


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def difference(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else a short description."""
    frame = query(spark, sf_dir)
    left = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    right = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns differ: {set(left[0]) ^ set(right[0])}"
    if len(left[1]) != len(right[1]):
        return f"row counts differ: {len(left[1])} vs {len(right[1])}"
    if kinds(left[1]) != kinds(right[1]):
        return f"types differ: {[(n, a, b) for n, a, b in zip(left[0], kinds(left[1]), kinds(right[1])) if a != b]}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"values differ: {[(n, x, y) for n, x, y in zip(left[0], a, b) if x != y][:6]}"
    return None

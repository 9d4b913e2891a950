"""Compare a query with its SQL check, values and types alike."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return f"decimal {value}"
    return f"{type(value).__name__} {value}"


def differences(frame, connection, sql: str, limit: int = 5) -> list[str]:
    """Empty where both sides have the same columns, types and rows."""
    rows = [tuple(row) for row in frame.collect()]
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    order = sorted(names)
    left = [frame.columns.index(name) for name in order]
    right = [names.index(name) for name in order]
    ours = Counter(tuple(_plain(row[i]) for i in left) for row in rows)
    theirs = Counter(tuple(_plain(row[i]) for i in right) for row in expected)
    found = []
    if len(rows) != len(expected):
        found.append(f"{len(rows)} rows against {len(expected)}")
    found += [f"only Spark: {row}" for row in list((ours - theirs))[:limit]]
    found += [f"only SQL:   {row}" for row in list((theirs - ours))[:limit]]
    return found

"""Compare a Spark result with DuckDB over the same parquet files, as multisets of rows."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float):
        return round(value, 9)
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> list[str]:
    """Empty when both sides agree in column names and rows."""
    cursor = connection.execute(sql)
    wanted_columns = [d[0] for d in cursor.description]
    if sorted(df.columns) != sorted(wanted_columns):
        return [f"columns differ: {sorted(df.columns)} / {sorted(wanted_columns)}"]
    got = as_rows(df.columns, df.collect())
    wanted = as_rows(wanted_columns, cursor.fetchall())
    extra, lost = got - wanted, wanted - got
    if not extra and not lost:
        return []
    return [f"{sum(got.values())} rows / {sum(wanted.values())} rows", f"only Spark: {list(extra)[:3]}",
            f"only SQL: {list(lost)[:3]}"]

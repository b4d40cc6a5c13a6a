"""Compare a Spark result with its SQL, regardless of row and column order."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return _sorted_rows([tuple(r) for r in df.collect()], df.columns)


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    return _sorted_rows(cursor.fetchall(), [d[0] for d in cursor.description])


def differences(df, connection, sql) -> str | None:
    """None when equal, else what differs first."""
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    expected = _sorted_rows(cursor.fetchall(), columns)
    actual = spark_rows(df)
    if len(expected) != len(actual):
        return f"rows {len(actual)} != {len(expected)}; first {actual[:1]} vs {expected[:1]}"
    for a, e in zip(actual, expected):
        if a != e or [type(x) for x in a] != [type(x) for x in e]:
            return f"row {a} != {e}"
    return None

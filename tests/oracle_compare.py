"""Run a registered query and its SQL over the same tables and compare them value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _lines(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


_FAMILY = {
    "bigint": "int64", "int": "int32", "double": "float64", "string": "str", "boolean": "bool", "date": "date",
    "timestamp": "timestamp", "BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "float64", "VARCHAR": "str",
    "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp",
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a DataFrame and the result of the SQL; empty when they are equal."""
    relation = con.sql(sql)
    columns, kinds = list(relation.columns), [str(t) for t in relation.types]
    found = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} and {sorted(columns)}"]
    mine = {name: _FAMILY.get(kind, kind) for name, kind in df.dtypes}
    theirs = {name: _FAMILY.get(kind, kind) for name, kind in zip(columns, kinds)}
    found += [f"type of {c}: {mine[c]} and {theirs[c]}" for c in columns if mine[c] != theirs[c]]
    left, right = _lines(df.columns, df.collect()), _lines(columns, relation.fetchall())
    if len(left) != len(right):
        found.append(f"{len(left)} rows and {len(right)}")
    pairs = [(a, b) for a, b in zip(left, right) if a != b]
    if pairs:
        found.append(f"{len(pairs)} rows differ, first {pairs[0]}")
    return found

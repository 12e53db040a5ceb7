"""Compare registered queries with their SQL oracles in DuckDB, value by value."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb


def open_duckdb(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        raise AssertionError(f"decimal in a published column: {value}")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when columns, row count and all values agree; else what differs."""
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    expected = Counter(tuple(_plain(r[i]) for i in order) for r in found.fetchall())
    names = sorted(columns)
    actual = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    if expected == actual:
        return ""
    missing, extra = expected - actual, actual - expected
    return (
        f"rows {sum(actual.values())} vs {sum(expected.values())};"
        f" only oracle {sum(missing.values())} {list(missing)[:2]};"
        f" only spark {sum(extra.values())} {list(extra)[:2]}; columns {names}"
    )

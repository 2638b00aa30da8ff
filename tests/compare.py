"""Run a query in Spark and its SQL in DuckDB, and compare rows as multisets."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        raise TypeError("decimals must not leave a query")
    return value


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    rows = [tuple(plain(r[i]) for i in order) for r in records]
    return names, sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark_df, con, sql, show=3):
    result = con.execute(sql)
    want = rows_of([c[0] for c in result.description], result.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(got[1])
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}", len(got[1])
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(want[1])} rows differ: {bad[:show]}", len(got[1])
    return None, len(got[1])

"""Order-insensitive comparison of a query with its SQL."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def _rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(cell(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(rows, key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return _rows([d[0] for d in cur.description], cur.fetchall())


def differences(mine, theirs, limit=3):
    """Empty list when equal."""
    if mine[0] != theirs[0]:
        return [("columns", mine[0], theirs[0])]
    if len(mine[1]) != len(theirs[1]):
        return [("rows", len(mine[1]), len(theirs[1]))]
    out = []
    for a, b in zip(mine[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(y) for y in b]:
            out.append((a, b))
            if len(out) == limit:
                break
    return out

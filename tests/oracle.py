"""Run one registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        if isinstance(value, float) and math.isnan(value):
            return "nan"
        return round(float(value), 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in data), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a description of the difference."""
    mine = rows(df.columns, df.collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    theirs = rows(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if mine == theirs:
        return None
    a, b = set(mine), set(theirs)
    return f"rows {len(mine)} vs {len(theirs)}; only spark {sorted(a - b, key=repr)[:3]}; only sql {sorted(b - a, key=repr)[:3]}"

"""Run a registered query and its SQL check side by side and compare them as multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return f"decimal {v}"
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_plain, v)) + "]"
    return repr(v)


def _multiset(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short account of the difference."""
    result = con.execute(sql)
    their_cols = [d[0] for d in result.description]
    theirs = _multiset(their_cols, result.fetchall())
    ours = _multiset(df.columns, df.collect())
    if sorted(df.columns) != sorted(their_cols):
        return f"columns {sorted(df.columns)} != {sorted(their_cols)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    return f"{len(bad)} of {len(ours)} rows differ, first: {bad[0]}" if bad else None

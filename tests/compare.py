"""Comparing a query with its SQL equivalent over the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v if isinstance(v, (int, str, bool)) else str(v)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(_plain(r[k]) for k in order) for r in rows), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    mine, theirs = rows_of(df.columns, df.collect()), rows_of(names, res.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} and {len(theirs)} rows"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows: {wrong[0]}" if wrong else None

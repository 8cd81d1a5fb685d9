"""Comparison of a query with its SQL twin in DuckDB, by values, in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return f"{float(value):.6g}"
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in found)


def assert_same(frame, sql: str, con: duckdb.DuckDBPyConnection) -> None:
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(frame.columns) == sorted(names)
    assert rows(frame.columns, [tuple(r) for r in frame.collect()]) == rows(names, want.fetchall())

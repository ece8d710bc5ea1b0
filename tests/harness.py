"""Runs a query on Spark and its SQL on DuckDB and compares the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, dict):
        return tuple((k, plain(v)) for k, v in sorted(x.items()))
    return x


def bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> None:
    """Asserts that both sides have the same columns and the same rows."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns), (names, df.columns)
    want, got = bag(cur.fetchall(), names), bag(df.collect(), df.columns)
    assert got == want, (sum(got.values()), sum(want.values()), list((got - want).items())[:3], list((want - got).items())[:3])

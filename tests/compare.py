"""Run a query in Spark and its SQL in DuckDB, and compare all rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when column names, row count and all values agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns: spark {sorted(df.columns)} sql {sorted(names)}"]
    got = [tuple(r) for r in df.collect()]
    a, b = _rows(df.columns, got), _rows(names, expected)
    if a == b:
        kinds_a = [{type(x).__name__ for x in c if x is not None} for c in zip(*a)] if a else []
        kinds_b = [{type(x).__name__ for x in c if x is not None} for c in zip(*b)] if b else []
        if kinds_a != kinds_b:
            return [f"types: {list(zip(sorted(names), kinds_a, kinds_b))}"]
        return []
    out = [f"rows: spark {len(got)} sql {len(expected)}; columns {sorted(names)}"]
    only_a, only_b = sorted((a - b).elements(), key=str), sorted((b - a).elements(), key=str)
    out.append(f"only in spark: {len(only_a)}, only in sql: {len(only_b)}")
    if only_a and only_b and len(only_a) == len(only_b):
        odd = [n for i, n in enumerate(sorted(names))
               if Counter(r[i] for r in only_a) != Counter(r[i] for r in only_b)]
        out.append(f"columns that differ: {odd}")
    out += [f"  spark {r}" for r in only_a[:2]] + [f"  sql   {r}" for r in only_b[:2]]
    return out

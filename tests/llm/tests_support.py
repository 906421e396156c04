"""Comparison of a query with its SQL in DuckDB."""

from __future__ import annotations

import duckdb

TABLES = "documents embeddings pages benchmark labels conversations".split()


def same_as_sql(spark, query, sql, sf_dir):
    got = query(spark, sf_dir)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    want = db.execute(sql)
    names = [d[0] for d in want.description]
    columns = sorted(names)
    assert sorted(got.columns) == columns
    order = [names.index(c) for c in columns]
    left = sorted(str(tuple(r[c] for c in columns)) for r in got.collect())
    right = sorted(str(tuple(r[i] for i in order)) for r in want.fetchall())
    assert left == right

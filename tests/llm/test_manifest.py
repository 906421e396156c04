"""The Merkle manifest against a plain version and its SQL."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from formfold.llm import merkle
from formfold.llm.queries import ORACLE, QUERIES
from tests_support import same_as_sql

from brute import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def chosen(r):
    return r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0


def without_breaks(r):
    return r[4].replace("\n", "") if chosen(r) and r[4] is not None else r[4]


def rows_of(sizes, seed=3):
    rnd = random.Random(seed)
    return [
        (rnd.choice([None, *range(3000)]), s, rnd.choice([None, "en"]), rnd.randrange(9), rnd.choice([None, "", "a\nb", "é\n\n", "x" * 99]))
        for s, n in sizes.items() for _ in range(n)
    ]


def found(df):
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = merkle.manifest(df, tampered={"text": text})
    out = out.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256), "folded_root", "verified")
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize(
    "sizes",
    [{}, {"a": 1}, {"a": 4, None: 1}, {f"s{i}": (1, 2, 3, 9, 10, 27, 28, 82)[i % 8] for i in range(31)}, {"x": 900, "y": 1, "Z": 30, "": 2}],
    ids=["empty", "one row", "null source", "many sources", "hot source"],
)
def test_manifest_equals_plain_version(spark, sizes, monkeypatch):
    monkeypatch.setattr(merkle, "WINDOW", 100)  # upper node rows are written several times
    rows = rows_of(sizes)
    assert found(spark.createDataFrame(rows, SCHEMA)) == sorted(manifest(rows, without_breaks), key=str)


def test_repeated_rows_and_clashing_columns(spark):
    rows = [(7, "s", "en", 3, "abc")] * 5 + [(7, "s", "en", 3, "a\nc")] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumns({c: F.lit(1) for c in ("number", "row", "hash", "id", "tree", "at", "place", "step", "lo")})
    assert found(df) == sorted(manifest(rows, without_breaks), key=str)


def test_the_guard_of_recursive_queries_is_restored(spark):
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), merkle.unlimited_recursion(spark):
        assert spark.conf.get(key) == "-1"
        raise ValueError
    assert spark.conf.get(key) == before


def test_manifest_equals_sql(spark):
    same_as_sql(spark, QUERIES["op11_merkle_manifest"], ORACLE["op11_merkle_manifest"], "/root/testdata/sf0.001")


def test_every_change_is_found(spark):
    rows = rows_of({"a": 40, "b": 7})
    out = found(spark.createDataFrame(rows, SCHEMA))
    changed = sum(without_breaks(r) != r[4] for r in rows)
    assert changed and sum(not r[-1] for r in out) == changed

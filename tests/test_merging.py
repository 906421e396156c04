"""Counts that merge, reports kept by date, and joins of rows without a key."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import functions as F

from formfold.operators import bitmap_counts, bitmap_table, extend_dictionary, hierarchy, spread_nulls
from formfold.plans.metrics import rollup_merge
from formfold.sinks import read_rollup, write_rollup
from formfold.workspace import materialize
from support import plan_text


def test_bitmaps_count_as_count_distinct_does(spark):
    rows = spark.range(4000).selectExpr("id % 7 AS day", "id % 3 AS kind", "if(id % 11 = 0, null, concat('u', id * id % 997)) AS user")
    ids, parts = None, []
    for d in (0, 3, 7):
        part = rows.filter((F.col("day") >= d - 3) & (F.col("day") < d) if d else F.col("day") < 0)
        ids = extend_dictionary(part, "user", ids)
        parts.append(bitmap_table(part, ["day", "kind"], "user", ids))
    days = rows.filter("day < 3 OR day >= 4")
    whole = parts[0].union(parts[1]).union(parts[2])
    for dims in (["day", "kind"], ["kind"], ["day"], []):
        want = days.groupBy(*dims).agg(F.countDistinct("user").alias("n")) if dims else days.agg(F.countDistinct("user").alias("n"))
        assert sorted(map(tuple, bitmap_counts(whole, dims).collect())) == sorted(map(tuple, want.collect()))


def test_a_dictionary_keeps_its_numbers(spark):
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "user string")
    first = extend_dictionary(frame("a", "b", "a", None), "user")
    both = extend_dictionary(frame("b", "c", None), "user", first)
    one, two = dict(map(tuple, first.collect())), dict(map(tuple, both.collect()))
    assert set(one) == {"a", "b"} and set(two) == {"a", "b", "c"} and len(set(two.values())) == 3
    assert all(two[k] == n for k, n in one.items())
    assert extend_dictionary(frame(), "user").count() == 0


def test_merging_bitmaps_never_reads_the_rows(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 5 AS day", "id % 17 AS user")
    table = bitmap_table(rows, ["day"], "user", extend_dictionary(rows, "user"))
    table.write.parquet(str(tmp_path / "b"))
    counts = bitmap_counts(spark.read.parquet(str(tmp_path / "b")), [])
    assert counts.first()[0] == 17
    assert "bitmap_or_agg" in plan_text(counts) and "Range" not in plan_text(counts)


MERGE = {"rollup": 1, "rollupAge": "DAY", "rollupRange": 10, "rollupCol": "date"}


def report(spark, low, high, mark):
    return spark.range(low, high).selectExpr("timestampadd(DAY, cast(id AS int), timestamp'2024-01-01') AS date", f"'{mark}' AS mark", "id AS n")


def files(path):
    return {str(p): os.stat(p).st_mtime_ns for p in Path(path).glob("rollup_on=*/*.parquet")}


def test_rollup_leaves_other_dates_alone(spark, tmp_path):
    path, old, new = str(tmp_path / "r"), report(spark, 0, 12, "old"), report(spark, 9, 15, "new")
    write_rollup(old, path, MERGE)
    assert read_rollup(spark, path, old.schema).count() == 10
    before = files(path)
    write_rollup(new, path, MERGE)
    found = read_rollup(spark, path, old.schema)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rollup_merge(old, new, MERGE).collect()))
    after = files(path)
    kept = {p for p in before if "2024-01-0" in p and p in after}
    assert len(kept) == 4 and all(after[p] == before[p] for p in kept)  # 6 to 9 January
    assert "Exchange" not in plan_text(found)


def test_rollup_of_formatted_dates_and_of_one_period(spark, tmp_path):
    merge = {**MERGE, "rollupCol": "date||%d-%m-%Y"}
    shown = lambda df: df.withColumn("date", F.date_format("date", "dd-MM-yyyy"))
    path, old, new = str(tmp_path / "r"), shown(report(spark, 20, 35, "old")), shown(report(spark, 31, 33, "new"))
    write_rollup(old, path, merge)
    write_rollup(new, path, merge)
    want = rollup_merge(rollup_merge(old, old, merge), new, merge)
    assert sorted(map(tuple, read_rollup(spark, path, old.schema).collect())) == sorted(map(tuple, want.collect()))
    write_rollup(new, path, {**merge, "rollup": 0})
    assert sorted(map(tuple, read_rollup(spark, path, old.schema).collect())) == sorted(map(tuple, new.collect()))


def test_rows_without_a_key_are_spread(spark):
    rows = spark.range(2000).selectExpr("id", "if(id % 10 = 0, concat('k', id % 30), null) AS key")
    keys = rows.select(spread_nulls(F.col("key"), F.col("id")).alias("k")).distinct()
    assert keys.filter("k LIKE 'k%'").count() == 3 and keys.count() > 1000


def test_levels_of_rows_with_and_without_keys(spark):
    dim = spark.createDataFrame([("state", "s1", "i1", "State 1"), ("block", "b1", "j1", "Block 1")], "entity_type string, key string, entity_id string, entity_name string")
    rows = spark.createDataFrame([(1, "s1", None), (2, None, "b1"), (3, None, None), (4, "zz", "b1")], "n int, state_externalId string, block_externalId string")
    found = hierarchy(rows, dim, ["state", "block"])
    assert sorted(map(tuple, found.select("n", "state_name", "block_id").collect()), key=str) == [(1, "State 1", None), (2, None, "j1"), (3, None, None), (4, None, "j1")]
    assert [r["n"] for r in hierarchy(rows, dim, ["state", "block"], require=["state"]).collect()] == [1]


def test_lookups_move_the_row_id_alone(spark):
    dim = spark.createDataFrame([("state", "s1", "i1", "State 1")], "entity_type string, key string, entity_id string, entity_name string")
    rows = spark.range(3).selectExpr("id", "concat('s', id) AS state_externalId", "concat('wide', id) AS note")
    found = hierarchy(rows, dim, ["state"], by=["id"]).select("id", "state_name")
    assert "wide" not in plan_text(found)
    assert sorted(map(tuple, found.collect())) == [(0, None), (1, "State 1"), (2, None)]


def test_a_folder_of_a_stored_table_is_read_alone(spark):
    dim = spark.createDataFrame([("state", "s"), ("block", "b"), ("my type", "t"), (None, "n")], "entity_type string, key string")
    stored = materialize(dim, "levels", ["entity_type"])
    words = materialize(dim.filter("key IN ('s', 'b')"), "levels", ["entity_type"])
    text = plan_text(words.filter("entity_type = 'state'"))
    assert text.count("+- Scan parquet") == 1 and "state AS entity_type" in text
    assert stored.columns == dim.columns
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, dim.collect()), key=str)

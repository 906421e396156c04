"""Hot keys and long histories: split work must give the same rows."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalog import derive
from support import SF
from formfold.operators import delta, distinct_report, latest, rows_at_max, spread_join
from formfold.plans.courses import course_progress


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def hot(spark, n=3000):
    """A third of the rows under one key, half of them tied at its maximum."""
    return spark.range(n).selectExpr(
        "id", "if(id % 3 = 0, 0, id % 50) AS k", "if(id % 2 = 0, 9, id % 9) AS v")


def test_spread_join_equals_join(spark):
    facts = hot(spark)
    lookup = facts.groupBy("k").agg(F.sum("v").alias("total"))
    assert rows(spread_join(facts, lookup, ["k"], hot_rows=100)) == rows(facts.join(lookup, "k"))


def test_spread_join_splits_the_hot_key(spark):
    facts = hot(spark)
    lookup = facts.groupBy("k").agg(F.sum("v").alias("total"))
    joined = spread_join(facts, lookup, ["k"], hot_rows=100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = joined.filter("k = 0").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    assert len(sizes) > 1


def test_copies_of_a_hot_key_travel_as_one_row(spark):
    facts = spark.createDataFrame([(1, "same")] * 1000 + [(2, "other")] * 3, "k int, v string")
    lookup = facts.groupBy("k").agg(F.max("v").alias("top"))
    joined = spread_join(facts, lookup, ["k"], hot_rows=100)
    assert rows(joined) == rows(facts.join(lookup, "k"))
    assert "_copies" in joined._jdf.queryExecution().optimizedPlan().toString()


def test_rows_at_max_keeps_all_ties_of_a_hot_key(spark):
    facts = hot(spark)
    best = F.max("v").over(W.partitionBy("k"))
    expected = facts.withColumn("best", best).filter("v = best")
    assert rows(rows_at_max(facts, ["k"], "v", "best", hot_rows=100)) == rows(expected)


def test_rows_at_max_drops_null_keys(spark):
    facts = spark.createDataFrame([(None, 1), ("a", None), ("a", 2)], "k string, v int")
    assert rows(rows_at_max(facts, ["k"], "v", "best")) == [(2, "a", 2)]


def test_course_progress_with_hot_learners(spark):
    scans = derive.course_scans(spark, SF)
    assert rows(course_progress(scans, hot_rows=5)) == rows(course_progress(scans))


def test_progress_is_compared_as_a_number(docs):
    from formfold import schemas

    event = {"Course_name": "c", "section_name": "s", "User_id": "u", "section_progress": "1"}
    scan = {"events": [{**event, "course_progress": p, "__time": t}
                       for p, t in (("9", "1000"), ("85", "2000"), ("100", "3000"))]}
    found = course_progress(docs(schemas.COURSE_SCAN, scan, {"events": []})).collect()
    assert [r["course_progress"] for r in found] == [100.0]


def test_delta_across_buckets_equals_one_window(spark):
    days = spark.range(400).selectExpr(
        "id % 2 AS page", "date_add(date'2023-01-01', cast(id * 7 as int)) AS day",
        "if(id % 11 = 0, null, (id * 37) % 101) AS total")
    before = F.lag("total").over(W.partitionBy("page").orderBy("day"))
    expected = days.withColumn("gain", F.coalesce(F.col("total") - before, F.lit(0)))
    assert rows(delta(days, ["page"], ["day"], "total", "gain")) == rows(expected)


def test_latest_takes_smallest_tie(spark):
    df = spark.createDataFrame([("a", 1, "y"), ("a", 2, "z"), ("a", 2, "x")], "k string, t int, n string")
    assert rows(latest(df, ["k"], ["t"], ["n"])) == [("a", "x", 2)]


def test_distinct_report_ids_of_mixed_types_and_nulls(spark):
    df = spark.createDataFrame(
        [("g", 1, "x", True), ("g", 1, "y", None), ("g", None, "x", False), (None, 2, None, True)],
        "g string, a int, b string, ok boolean")
    report = distinct_report(
        df, ["g"], {"n": ("a", None), "m": ("b", F.col("ok")), "o": ("a", F.col("ok"))})
    assert rows(report) == [("g", 1, 1, 1), (None, 0, 1, 1)]


def test_spread_join_splits_the_hot_key_where_some_keys_suffice(spark):
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        test_spread_join_splits_the_hot_key(spark)
    finally:
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")

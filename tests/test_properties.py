"""Properties that hold for any input."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from formfold.functions import distinct_structs
from formfold.operators import distinct_if, explode_rows, melt, pivot
from formfold.plans.metrics import rollup_merge
from formfold.sinks import split_write

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
cells = st.tuples(st.integers(-9, 9), st.integers(-9, 9))


@FEW
@given(st.lists(cells, min_size=1, max_size=12))
def test_melt_then_pivot_is_the_same_table(spark, values):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(values)], "id int, a int, b int")
    back = pivot(melt(df, ["id"], ["a", "b"]), ["id"], "variable", ["a", "b"], [F.min("value")])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


@FEW
@given(st.lists(st.lists(st.integers(0, 3), max_size=4), min_size=1, max_size=8))
def test_explode_keeps_empty_rows(spark, lists):
    df = spark.createDataFrame([(v,) for v in lists], "v array<int>")
    assert explode_rows(df, "v", "x").count() == sum(max(1, len(v)) for v in lists)


@FEW
@given(st.lists(st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["a", None])), max_size=5),
                min_size=1, max_size=6))
def test_distinct_structs_equals_exact_distinct(spark, lists):
    df = spark.createDataFrame([(v,) for v in lists], "v array<struct<a:int,b:string>>")
    assert df.select(distinct_structs("v")).collect() == df.select(F.array_distinct("v")).collect()


@FEW
@given(st.lists(st.tuples(st.integers(0, 5), st.booleans()), min_size=1, max_size=20))
def test_conditional_distinct_is_never_more(spark, values):
    df = spark.createDataFrame(values, "id int, ok boolean")
    some, every = df.agg(distinct_if(F.col("ok"), "id"), F.countDistinct("id")).first()
    assert some == len({i for i, ok in values if ok}) <= every


@FEW
@given(st.sets(st.integers(1, 28), min_size=1), st.sets(st.integers(1, 28), min_size=1), st.integers(1, 30))
def test_rollup_merge_twice_is_once(spark, old, new, keep):
    def frame(days, n):
        rows = [(f"2024-01-{d:02d} 00:00:00", n) for d in sorted(days)]
        return spark.createDataFrame(rows, "date string, n int").withColumn("date", F.to_timestamp("date"))

    merge = {"rollup": 1, "rollupAge": "DAY", "rollupRange": keep, "rollupCol": "date"}
    once = rollup_merge(frame(old, 1), frame(new, 2), merge)
    twice = rollup_merge(once, frame(new, 2), merge)
    newest = max(old | new)
    expected = sorted((d, 2 if d in new else 1) for d in old | new if d > newest - keep)
    for merged in (once, twice):
        assert sorted((r["date"].day, r["n"]) for r in merged.collect()) == expected


def test_split_write_loses_nothing(spark, tmp_path):
    df = spark.createDataFrame(
        [("Prog A", "S 1", 1), (" prog  a ", "S 1", 2), (None, "S 2", 3), ("", "S 2", 4)],
        "program_name string, solution_name string, n int")
    path = split_write(df, ["program_name", "solution_name"], str(tmp_path / "out"), fmt="parquet")
    back = spark.read.parquet(path)
    assert sorted(r["n"] for r in back.collect()) == [1, 2, 3, 4]
    slugs = {(r["program_slug"], r["solution_slug"]) for r in back.collect()}
    assert slugs == {("prog_a", "s_1"), ("programname_notdefined", "s_2")}

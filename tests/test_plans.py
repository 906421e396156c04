"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from catalog import load
from support import SF, plan_text
from formfold.operators import latest
from formfold.plans.projects import project_report
from formfold.sources import scan

# writing queries start jobs of their own; their reports are covered by the others
QUERIES = load()[0]
LAZY = sorted(n for n, fn in QUERIES.items() if fn.__module__ != "catalog.files")


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pairwise_joins(spark, name):
    text = plan_text(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_project_report_does_not_shuffle(spark):
    from formfold import schemas

    empty = spark.createDataFrame([], schemas.PROJECT)
    assert "Exchange" not in plan_text(project_report(empty))


def _generated(df):
    """What the generators of a plan read that make rows of organisations or of ``_rows``, in the order they run."""
    found = re.findall(r"Arguments: ((?:explode|inline)\w*\(\w+)", plan_text(df))
    return [g for g in found if g.endswith(("(array_distinct", "(_rows"))]


def test_organisations_repeat_projects_not_the_rows_of_tasks(spark):
    from formfold import schemas

    found = _generated(project_report(spark.createDataFrame([], schemas.PROJECT)))
    assert found == ["explode(array_distinct", "explode(_rows"]


def test_organisations_repeat_surveys_not_the_rows_of_answers(spark):
    assert _generated(QUERIES["survey_answers"](spark, SF)) == ["explode(array_distinct", "inline(_rows"]


def test_latest_prunes_before_the_shuffle(spark):
    rows = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan_text(latest(rows, ["o_custkey"], ["o_orderdate"], ["o_orderkey"]))
    assert text.count("WindowGroupLimit") >= 2  # once before and once after the exchange


def test_scan_pushes_filters_and_prunes_columns(spark):
    from pyspark.sql import functions as F

    events = spark.read.parquet(f"{SF}/events.parquet")
    text = plan_text(
        scan(events, ["event_id"], [F.col("event_type") == "click"], "ts", "2024-01-10", "2024-01-20"))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "EqualTo(event_type,click)" in pushed
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in text

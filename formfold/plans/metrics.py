"""Metric reports described by a dict: filters, granularity, counts, labels, rollup."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formfold.operators import distinct_if


def spec_filter(filters: list[dict]) -> Column:
    """All filters of a metric as one condition: ``equals`` and ``in``."""
    conditions = []
    for f in filters:
        if f["type"] == "equals":
            conditions.append(F.col(f["dimension"]) == F.lit(f["value"]))
        elif f["type"] == "in":
            conditions.append(F.col(f["dimension"]).isin(f["values"]))
        else:
            raise ValueError(f"unknown filter type: {f['type']}")
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _measure(aggregation: dict, condition: Column) -> Column:
    kind, name = aggregation["type"], aggregation["name"]
    if kind == "count":
        return F.count_if(condition).alias(name)
    if kind == "countDistinct":
        return distinct_if(condition, aggregation["fieldName"]).alias(name)
    raise ValueError(f"unknown aggregation type: {kind}")


def _metric_conditions(spec: dict) -> list[Column]:
    """Filter of each metric, within the spec's half-open date range."""
    return [spec_filter(m["druidQuery"].get("filters", [])) for m in spec["metrics"]]


def _in_range(df: DataFrame, spec: dict, ts: str) -> DataFrame:
    span = spec.get("dateRange", {}).get("interval")
    if not span:
        return df
    kind = df.schema[ts].dataType
    return df.filter(
        (F.col(ts) >= F.lit(span["startDate"]).cast(kind))
        & (F.col(ts) < F.lit(span["endDate"]).cast(kind))
    )


def time_metrics(df: DataFrame, spec: dict, ts: str = "ts") -> DataFrame:
    """All metrics of a time-series spec in one pass, merged on the date.

    Rows no metric wants are filtered before the grouping, so empty buckets do
    not appear. Granularity ``all`` gives one row.
    """
    conditions = _metric_conditions(spec)
    df = _in_range(df, spec, ts).filter(reduce(lambda a, b: a | b, conditions))
    measures = [
        _measure(a, condition)
        for metric, condition in zip(spec["metrics"], conditions)
        for a in metric["druidQuery"]["aggregations"]
    ]
    granularity = spec.get("dateRange", {}).get("granularity", "day")
    keys = [] if granularity == "all" else [F.date_trunc(granularity, ts).alias("date")]
    return df.groupBy(*keys).agg(*measures).withColumnsRenamed(spec.get("labels", {}))


def _looked_up(df: DataFrame, dimension: dict, lookups: dict[str, DataFrame]) -> DataFrame:
    """Add a dimension under its alias, through its lookups if it has any.

    A lookup is a frame of ``key`` and ``value``; with ``retainMissingValue`` a
    value it does not know stays, otherwise it becomes null. Lookups come before
    the grouping, since two keys may share a value.
    """
    name = dimension["aliasName"]
    df = df.withColumn(name, F.col(dimension["fieldName"]))
    for step in dimension.get("extractionFn", []):
        if step["type"] != "registeredLookup":
            raise ValueError(f"unknown extraction: {step['type']}")
        known = lookups[step["fn"]].select(
            F.col("key").alias(name), F.col("value").alias("_value")
        )
        value = F.coalesce("_value", name) if step.get("retainMissingValue") else F.col("_value")
        df = df.join(known, name, "left").withColumn(name, value).drop("_value")
    return df


def _order_measure(name: str) -> Column | None:
    """``COUNT_DISTINCT(c)`` as a measure to order by; None for the name of a column."""
    found = re.fullmatch(r"COUNT_DISTINCT\((\w+)\)", name)
    return F.countDistinct(found.group(1)).alias(name) if found else None


def group_report(
    df: DataFrame, spec: dict, ts: str = "ts", lookups: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Groups of a dimension list with their counts, ordered and limited by the spec.

    The order may name an aggregation, a dimension or ``COUNT_DISTINCT(column)``,
    which is computed for the order and not shown. Dimensions settle ties; a limit
    without an order takes groups in dimension order. Several metrics must have the
    same dimensions: a group that any of them has gets a row, with nulls for the
    others' measures.
    """
    queries = [m["druidQuery"] for m in spec["metrics"]]
    names = [d["aliasName"] for d in queries[0]["dimensions"]]
    if any([d["aliasName"] for d in q["dimensions"]] != names for q in queries):
        raise ValueError("the metrics of a group report must have the same dimensions")
    measures = [a["name"] for q in queries for a in q.get("aggregations", [])]
    if len(set(measures)) < len(measures):
        raise ValueError("two metrics of a group report have a measure of one name")
    ranged = _in_range(df, spec, ts)
    groups = _groups(ranged, queries[0], names, lookups or {})
    for query in queries[1:]:
        groups = _beside(groups, _groups(ranged, query, names, lookups or {}), names)
    shown = groups.select(*[F.col(f"`{n}`") for n in [*names, *measures]])
    return shown.withColumnsRenamed(spec.get("labels", {}))


def _groups(df: DataFrame, query: dict, names: list[str], lookups: dict) -> DataFrame:
    """The groups of one metric."""
    df = df.filter(spec_filter(query.get("filters", [])))
    for dimension in query["dimensions"]:
        df = _looked_up(df, dimension, lookups)
    measures = {a["name"]: _measure(a, F.lit(True)) for a in query.get("aggregations", [])}
    limit = query.get("limitSpec", {})
    order = limit.get("columns", [])
    hidden = {c["dimension"]: _order_measure(c["dimension"]) for c in order}
    hidden = {name: m for name, m in hidden.items() if m is not None}
    every = [*measures.values(), *hidden.values()]
    groups = df.groupBy(*names).agg(*every) if every else df.select(*names).distinct()
    by = [
        F.col(f"`{c['dimension']}`").desc() if c["direction"] == "descending"
        else F.col(f"`{c['dimension']}`").asc()
        for c in order
    ]
    if "limit" in limit:
        return groups.orderBy(*by, *names).limit(limit["limit"])
    return groups.orderBy(*by, *names) if by else groups


def _beside(a: DataFrame, b: DataFrame, names: list[str]) -> DataFrame:
    """Full outer join on the dimensions, where nulls are equal."""
    other = b.withColumnsRenamed({n: f"_{n}" for n in names})
    same = [a[f"`{n}`"].eqNullSafe(other[f"`_{n}`"]) for n in names]
    both = a.join(other, same, "outer")
    keys = {n: F.coalesce(F.col(f"`{n}`"), F.col(f"`_{n}`")) for n in names}
    return both.withColumns(keys).drop(*[f"_{n}" for n in names])


# Date letters of a rollup column and what Spark calls them.
_DATE_LETTERS = {"%d": "dd", "%m": "MM", "%Y": "yyyy", "%H": "HH", "%M": "mm", "%S": "ss"}


def rollup_column(merge: dict) -> tuple[str, str | None]:
    """Name and Spark date format of ``rollupCol``, given as ``name||format`` or ``name``."""
    name, _, letters = merge["rollupCol"].partition("||")
    for letter, spark_letter in _DATE_LETTERS.items():
        letters = letters.replace(letter, spark_letter)
    return name, letters or None


def rollup_merge(previous: DataFrame, new: DataFrame, merge: dict) -> DataFrame:
    """Previous report plus the new period: same dates replaced, old dates dropped.

    Keeps the last ``rollupRange`` units of ``rollupAge`` up to the newest date
    of ``rollupCol``, a timestamp or a text with a format. ``rollup`` 0 keeps the
    new period alone.
    """
    if not merge.get("rollup"):
        return new
    name, letters = rollup_column(merge)
    kept = previous.join(new.select(name).distinct(), name, "left_anti")
    merged = kept.unionByName(new)
    date = F.to_timestamp(name, letters) if letters else F.col(name)
    newest = merged.agg(F.max(date)).scalar()
    oldest = F.timestamp_add(merge["rollupAge"].upper(), F.lit(-merge["rollupRange"]), newest)
    return merged.filter(date > oldest)

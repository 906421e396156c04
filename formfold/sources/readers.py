"""Scans of documents, reports, telemetry responses and streams."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.functions import as_column

#: Rows of a spread scan that one task may take.
TASK_ROWS = 100_000


def read_docs(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    """Documents with an explicit nested schema (no inference pass over the data)."""
    return spark.read.schema(schema).format(fmt).load(path)


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines, plain or compressed. Without a schema Spark reads the data twice."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def read_csv(spark: SparkSession, path: str, fill: str | None = "") -> DataFrame:
    """CSV with a header, all columns text; nulls become ``fill``."""
    df = spark.read.option("header", True).csv(path)
    return df if fill is None else df.na.fill(fill)


def params(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Distinct run parameters from a CSV column, to be used in a left-semi join."""
    return read_csv(spark, path, fill=None).select(column).na.drop().distinct()


def unwrap(df: DataFrame, column: str = "events") -> DataFrame:
    """Scan responses to one row per event; an empty response keeps a null row."""
    return df.select(F.explode_outer(column).alias(column)).select(f"{column}.*")


def spread(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Redistribute a scan that has fewer splits than the cluster has cores or its rows ask for.

    A few files that cannot be split (gzip JSON, one row group) would leave all
    wide work after them to a few tasks, and a split of flat columns holds millions of
    rows, so what a task makes and groups of them would grow with the table. A scan with enough
    splits stays as it is, without a shuffle; so does a stream. The rows are counted from
    the files' footers.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, math.ceil(df.count() / task_rows))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def scan(
    df: DataFrame,
    columns: list[str],
    filters: Iterable[Column] = (),
    ts: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Filtered, pruned scan of the half-open interval [start, end).

    The bounds are literals of the column's own type, so they reach the file scan.
    """
    if ts:
        kind = df.schema[ts].dataType.simpleString()
        if start:
            df = df.filter(F.col(ts) >= F.lit(start).cast(kind))
        if end:
            df = df.filter(F.col(ts) < F.lit(end).cast(kind))
    for condition in filters:
        df = df.filter(condition)
    return df.select(*columns)


def last_days(
    df: DataFrame, ts: str, days: int, as_of: str | Column | None = None
) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of`` (now by default)."""
    kind = df.schema[ts].dataType.simpleString()
    if as_of is None:
        as_of = F.current_timestamp()
    elif isinstance(as_of, str):
        as_of = F.lit(as_of)
    as_of = as_of.cast(kind)
    return df.filter(
        (F.col(ts) >= as_of - F.make_dt_interval(F.lit(days))) & (F.col(ts) <= as_of)
    )


def read_stream(
    spark: SparkSession, fmt: str, path: str | None = None, schema: str | None = None, **options
) -> DataFrame:
    """Streaming source: ``kafka`` with its options, or a folder of files."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def records(stream: DataFrame, schema: str, value: Column | str = "value") -> DataFrame:
    """Decode JSON bytes into typed columns, keeping the text of each record.

    ``_raw`` holds the text; a record that is not a JSON object has ``_bad`` set.
    The generator keeps filters on the columns from parsing each text again for themselves.
    """
    text = as_column(value).cast("string")
    doc = F.from_json("_raw", f"{schema.strip()}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    return stream.select(text.alias("_raw")).select("_raw", F.inline(F.array(doc)))

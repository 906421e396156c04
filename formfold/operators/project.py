"""Projection helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["fill", "project", "relabel", "with_missing", "with_time_stamp"]


def project(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Select nested paths under new names: ``{alias: "a.b.c"}``."""
    return df.select(*[F.col(path).alias(alias) for alias, path in paths.items()])


def relabel(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(labels)


def fill(df: DataFrame, value, columns: list[str] | None = None) -> DataFrame:
    return df.na.fill(value, subset=columns)


def with_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the absent columns of ``{name: type}`` as typed nulls."""
    absent = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(absent)


def with_time_stamp(df: DataFrame, name: str = "time_stamp") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())

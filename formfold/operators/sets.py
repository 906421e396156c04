"""Unions, sorting and limits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = [
    "head",
    "missing_columns",
    "sort",
    "top",
    "union_all",
    "union_branches",
    "union_many",
]


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Matched by name: by position, same-typed columns could swap silently."""
    return a.unionByName(b)


def union_branches(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns absent on one side become nulls."""
    return a.unionByName(b, allowMissingColumns=True)


def union_many(frames: list[DataFrame]) -> DataFrame:
    return reduce(union_branches, frames)


def missing_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns of ``a`` that ``b`` lacks."""
    return [c for c in a.columns if c not in set(b.columns)]


def sort(df: DataFrame, columns: list[str], ascending: bool | list[bool] = True) -> DataFrame:
    return df.orderBy(*columns, ascending=ascending)


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def top(df: DataFrame, measure: str, n: int, ties: list[str]) -> DataFrame:
    """The n largest by ``measure``; ``ties`` fix the order among equals."""
    return df.orderBy(F.desc(measure), *ties).limit(n)

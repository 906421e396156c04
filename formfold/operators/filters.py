"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "ANSWER_TYPES",
    "answer_types",
    "completed_only",
    "contains",
    "dated_only",
    "drop_null",
    "having",
    "matches",
    "split_null",
    "where",
    "with_evidence",
]

# Response types that carry one answer.
ANSWER_TYPES = ["text", "radio", "multiselect", "slider", "number", "date"]


def where(df: DataFrame, *conditions: Column) -> DataFrame:
    for condition in conditions:
        df = df.filter(condition)
    return df


def split_null(df: DataFrame, c: str) -> tuple[DataFrame, DataFrame]:
    """(rows where ``c`` is null, rows where it is not)."""
    return df.filter(F.col(c).isNull()), df.filter(F.col(c).isNotNull())


def drop_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def having(df: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """Groups whose aggregate meets a condition, e.g. ``F.count("*") >= 2``."""
    return df.groupBy(*keys).agg(condition.alias("_keep")).filter("_keep").drop("_keep")


def contains(df: DataFrame, c: str, text: str) -> DataFrame:
    return df.filter(F.col(c).contains(text))


def matches(df: DataFrame, c: str, pattern: str) -> DataFrame:
    return df.filter(F.col(c).rlike(pattern))


def completed_only(df: DataFrame) -> DataFrame:
    """Completed submissions that say whether their program is private."""
    return df.filter((F.col("status") == "completed") & F.col("isAPrivateProgram").isNotNull())


def dated_only(df: DataFrame, c: str = "completedDate") -> DataFrame:
    return df.filter(F.col(c).isNotNull())


def with_evidence(df: DataFrame, c: str = "evidence_count") -> DataFrame:
    return df.filter(F.col(c) > 0)


def answer_types(df: DataFrame, c: str, types: list[str] = ANSWER_TYPES) -> DataFrame:
    return df.filter(F.col(c).isin(types))

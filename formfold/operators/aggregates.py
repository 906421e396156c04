"""Group metrics and de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .skew import HOT_ROWS, spread_join

__all__ = [
    "count_by",
    "distinct",
    "distinct_by",
    "distinct_if",
    "distinct_report",
    "first_by",
    "latest",
    "max_by_key",
    "n_rows",
    "rows_at_max",
    "users_by_month",
    "values",
]


def count_by(df: DataFrame, keys: list[str], alias: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(alias))


def distinct_by(df: DataFrame, keys: list[str], c: str, alias: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct(c).alias(alias))


def distinct_if(condition: Column, c: Column | str) -> Column:
    """Distinct values of ``c`` among rows where the condition holds."""
    return F.countDistinct(F.when(condition, F.col(c) if isinstance(c, str) else c))


def distinct_report(
    df: DataFrame, dims: list[str], specs: dict[str, tuple[str, Column | None]]
) -> DataFrame:
    """Several conditional distinct counts per group: ``{alias: (id column, condition)}``.

    Step one keeps one row per (group, id) with one flag per count; it combines
    before the shuffle and spreads a hot group over its ids. Step two adds up
    the flags. Counts over the same id column share one pass, so a row is
    repeated once per id column rather than once per count.
    """
    by_id: dict[str, list[tuple[str, Column | None]]] = {}
    for alias, (id_column, condition) in specs.items():
        by_id.setdefault(id_column, []).append((alias, condition))
    width = max(len(group) for group in by_id.values())
    types = {dict(df.dtypes)[id_column] for id_column in by_id}
    id_type = types.pop() if len(types) == 1 else "string"

    kinds = []
    for kind, (id_column, group) in enumerate(by_id.items()):
        flags = [
            F.coalesce(condition, F.lit(False)) if condition is not None else F.lit(True)
            for _, condition in group
        ] + [F.lit(False)] * (width - len(group))
        kinds.append(
            [
                F.lit(kind).alias("_kind"),
                F.col(id_column).cast(id_type).alias("_id"),
                *[f.alias(f"_f{i}") for i, f in enumerate(flags)],
            ]
        )
    flag_names = [f"_f{i}" for i in range(width)]
    if len(kinds) == 1:
        rows = df.select(*dims, *kinds[0])
    else:
        rows = df.select(*dims, F.inline(F.array(*[F.struct(*k) for k in kinds])))
    ids = rows.groupBy(*dims, "_kind", "_id").agg(*[F.max(f).alias(f) for f in flag_names])
    counts = [
        F.count_if(
            (F.col("_kind") == kind) & F.col("_id").isNotNull() & F.col(f"_f{i}")
        ).alias(alias)
        for kind, group in enumerate(by_id.values())
        for i, (alias, _) in enumerate(group)
    ]
    return ids.groupBy(*dims).agg(*counts).select(*dims, *specs)


def first_by(df: DataFrame, keys: list[str], c: str, alias: str) -> DataFrame:
    """A value per key; the smallest non-null one, so that reruns agree."""
    return df.groupBy(*keys).agg(F.min(c).alias(alias))


def max_by_key(df: DataFrame, keys: list[str], c: str, alias: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(c).alias(alias))


def distinct(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def latest(
    df: DataFrame, keys: list[str], newest: list[str], ties: list[str] = ()
) -> DataFrame:
    """One row per key: largest ``newest`` columns first, then smallest ``ties``.

    The rank filter is applied inside each input task before the shuffle, so a
    hot key sends one row per task.
    """
    order = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in newest], *[F.asc(c) for c in ties])
    return df.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")


def rows_at_max(
    df: DataFrame, keys: list[str], c: str, alias: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All rows that reach their key's maximum of ``c``; rows with a null key drop out.

    The maximum is combined before its shuffle and joined back with hot keys
    split, because any number of rows may tie at the maximum.
    """
    facts = df.na.drop(subset=[*keys, c])
    per_key = facts.groupBy(*keys).agg(F.max(c).alias(alias), F.count("*").alias("n"))
    joined = spread_join(
        facts, per_key.drop("n"), keys, per_key.select(*keys, "n"), hot_rows
    )
    return joined.filter(F.col(c) == F.col(alias))


def values(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).distinct()


def n_rows(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    return df.agg(F.count("*").alias(alias))


def users_by_month(df: DataFrame, user: str, ts: str, since: str) -> DataFrame:
    """Distinct users per month from a date on."""
    recent = df.filter(F.col(ts) >= F.lit(since).cast(df.schema[ts].dataType))
    month = F.date_format(ts, "yyyy-MM").alias("month")
    return recent.groupBy(month).agg(F.countDistinct(user).alias("unique_users"))

"""Dimension lookups, semi and anti joins.

No lookup forces a broadcast: dimensions grow with the data, so the planner
decides by size and adaptive execution corrects it from the measured shuffle.
A caller's own broadcast mark survives the projections made here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

__all__ = [
    "LEVELS",
    "entity_keys",
    "hierarchy",
    "join_any_key",
    "join_app",
    "keep_known",
    "left_lookup",
    "melted_keys",
    "merge_reports",
    "natural",
    "new_rows",
    "outer",
    "spread_nulls",
    "with_name",
]

# Location levels from the widest to the narrowest.
LEVELS = ["state", "district", "block", "cluster", "school"]

#: Over how many keys rows without a key are spread.
NULL_KEYS = 4096


def with_name(
    df: DataFrame, dim: DataFrame, key: str, alias: str, dim_key: str = "_id", name: str = "name"
) -> DataFrame:
    """Inner join that adds the dimension's name as ``alias``."""
    return df.join(dim.select(F.col(dim_key).alias(key), F.col(name).alias(alias)), key)


def left_lookup(df: DataFrame, dim: DataFrame, keys: str | list[str]) -> DataFrame:
    """Left join on one or more keys; also valid for a streaming left side."""
    return df.join(dim, keys, "left")


def outer(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b, keys, "outer")


def melted_keys(dim: DataFrame, key_columns: list[str], alias: str) -> DataFrame:
    """One row per dimension row and distinct non-null key: turns an OR-join into an equi-join."""
    keys = F.array_distinct(F.array_compact(F.array(*key_columns)))
    return dim.withColumn(alias, F.explode(keys))


def join_any_key(
    df: DataFrame, dim: DataFrame, key: str, dim_keys: list[str], how: str = "inner"
) -> DataFrame:
    """Join where ``key`` equals any of the dimension's keys."""
    return df.join(melted_keys(dim, dim_keys, key).drop(*dim_keys), key, how)


def entity_keys(entities: DataFrame) -> DataFrame:
    """Entity documents to (entity_type, key, entity_id, entity_name).

    Each entity can be found by its location id or its code. Should two
    entities of a type share a key, the smaller id is kept, so a lookup never
    multiplies rows.
    """
    flat = entities.select(
        F.col("entityType").alias("entity_type"),
        F.col("_id").alias("entity_id"),
        F.col("metaInformation.name").alias("entity_name"),
        F.col("registryDetails.locationId").alias("_location"),
        F.col("registryDetails.code").alias("_code"),
    )
    return (
        melted_keys(flat, ["_location", "_code"], "key")
        .groupBy("entity_type", "key")
        .agg(F.min(F.struct("entity_id", "entity_name")).alias("e"))
        .select("entity_type", "key", "e.*")
    )


def spread_nulls(key: Column, by: Column) -> Column:
    """A text key for a left join: nulls become keys that nothing has, spread by another value of the row.

    Rows without a key would all go to one task of a shuffled join, though none finds a partner.
    """
    nothing = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(by), F.lit(NULL_KEYS)).cast("string"))
    return F.coalesce(key.cast("string"), nothing)


def hierarchy(
    df: DataFrame,
    keys: DataFrame,
    levels: list[str] = LEVELS,
    require: list[str] = (),
    key_suffix: str = "_externalId",
    by: list[str] | None = None,
) -> DataFrame:
    """Add ``<level>_name`` and ``<level>_id`` for each ``<level>_externalId``.

    ``keys`` comes from :func:`entity_keys`. Levels in ``require`` drop the rows
    that have no match. Rows without a key are spread by the columns ``by``: name the
    row's id, as all other values, the default, have to move with the rows for it.
    """
    plain = by or [f.name for f in df.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    for level in levels:
        on = level + key_suffix
        dim = keys.filter(F.col("entity_type") == level).select(
            F.col("key").alias("_key"),
            F.col("entity_name").alias(f"{level}_name"),
            F.col("entity_id").alias(f"{level}_id"),
        )
        if level in require:
            df = df.join(dim, F.col(on) == F.col("_key")).drop("_key")
        else:
            df = df.join(dim, spread_nulls(F.col(on), F.xxhash64(*plain)) == F.col("_key"), "left").drop("_key")
    return df


def join_app(
    df: DataFrame, users: DataFrame, user: str, users_key: str, app: str, apps: list[str]
) -> DataFrame:
    """Join users to rows of the given apps only.

    The app condition touches the left side alone, so it becomes a filter
    below the join instead of a condition inside it.
    """
    kept = df.filter(F.col(app).isin(apps))
    return kept.join(users.withColumnRenamed(users_key, user), user)


def keep_known(df: DataFrame, known: DataFrame, keys: str | list[str]) -> DataFrame:
    """Rows whose key occurs in ``known``."""
    return df.join(known, keys, "left_semi")


def new_rows(df: DataFrame, old: DataFrame, keys: str | list[str]) -> DataFrame:
    """Rows whose key does not occur in ``old``."""
    return df.join(old, keys, "left_anti")


def merge_reports(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Inner join on all shared columns, with missing text filled so blanks match."""
    return a.na.fill("").join(b.na.fill(""), columns)


def natural(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join on every column name the two share."""
    return a.join(b, [c for c in a.columns if c in set(b.columns)])

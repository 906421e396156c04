"""Exact distinct counts that merge: bitmaps over dense ids.

A distinct count of a month is not the sum of its days', so reports at several grains
would each read the raw rows again. Here ids get dense numbers once, in a written
dictionary that later periods extend; a bitmap table holds, for each group, the numbers
seen, 32,768 to a row. Days merge into months and groups into fewer dimensions by a bitwise
or of these rows, and counts are sums of set bits: exact, and never again over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.workspace import materialize

__all__ = ["bitmap_counts", "bitmap_table", "extend_dictionary", "merge_bitmaps", "new_ids"]


def new_ids(values: DataFrame, column: str, dictionary: DataFrame | None = None) -> DataFrame:
    """(column, number) of the values that the dictionary lacks; nulls get none.

    Numbers are dense in what each task writes, and begin behind the dictionary's last.
    Written before they are used: a task that runs again would number anew.
    """
    fresh = values.select(column).na.drop().distinct()
    first = 0
    if dictionary is not None:
        fresh = fresh.join(dictionary, column, "left_anti")
        last = dictionary.agg(F.max("number")).first()[0]
        first = 0 if last is None else last + 1
    return materialize(fresh.withColumn("number", F.monotonically_increasing_id() + first), "ids")


def extend_dictionary(values: DataFrame, column: str, dictionary: DataFrame | None = None) -> DataFrame:
    """The dictionary with the values it lacked; numbers it has given stay."""
    fresh = new_ids(values, column, dictionary)
    return fresh if dictionary is None else dictionary.unionByName(fresh)


def bitmap_table(df: DataFrame, dims: list[str], column: str, dictionary: DataFrame) -> DataFrame:
    """(dims, bucket, bitmap): the numbers of the column's values in each group.

    Rows are reduced to distinct (group, value) in each task before the lookup, so a hot
    value meets its number once per group and task, not once per row.
    """
    numbered = df.select(*dims, column).na.drop(subset=[column]).distinct().join(dictionary, column)
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number"))
    return numbered.groupBy(*dims, F.bitmap_bucket_number("number").alias("bucket")).agg(bits.alias("bitmap"))


def merge_bitmaps(table: DataFrame, dims: list) -> DataFrame:
    """The table for fewer or coarser dimensions (names or columns): days to months, groups to all."""
    return table.groupBy(*dims, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bitmap_counts(table: DataFrame, dims: list, alias: str = "n") -> DataFrame:
    """Exact distinct counts by dimensions that the table holds or that follow from them."""
    merged = merge_bitmaps(table, dims)
    names = [c for c in merged.columns if c not in ("bucket", "bitmap")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bitmap")).alias(alias))

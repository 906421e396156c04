"""Row-to-row comparison along time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

__all__ = ["delta"]


def delta(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    alias: str,
    bucket: Column | None = None,
) -> DataFrame:
    """Difference to the previous row of the same key; 0 for the first row.

    The window runs per (key, time bucket), so a key with a long history spreads
    over many tasks. The last value of the bucket before is carried over from a
    table with one row per (key, bucket). ``bucket`` must not decrease along
    ``order``; it is the month of the first order column by default.
    """
    bucket = bucket if bucket is not None else F.date_trunc("month", order[0])
    parts = df.withColumn("_bucket", bucket)
    inside = W.partitionBy(*keys, "_bucket").orderBy(*order)
    rows = parts.withColumns(
        {"_before": F.lag(value).over(inside), "_place": F.row_number().over(inside)}
    )
    ends = parts.groupBy(*keys, "_bucket").agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_end")
    )
    carried = ends.select(
        *keys,
        "_bucket",
        F.lag("_end").over(W.partitionBy(*keys).orderBy("_bucket"))["v"].alias("_carry"),
    )
    before = F.when(F.col("_place") == 1, F.col("_carry")).otherwise(F.col("_before"))
    return (
        rows.join(carried, [*keys, "_bucket"], "left")
        .withColumn(alias, F.coalesce(F.col(value) - before, F.lit(0)))
        .drop("_bucket", "_before", "_place", "_carry")
    )

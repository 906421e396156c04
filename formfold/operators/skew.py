"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["HOT_ROWS", "spread_join"]

# Rows of one key that a single join task may take. There can be at most
# (rows / HOT_ROWS) hot keys, which bounds the list of them: 10^12 rows give
# 10^5 keys.
HOT_ROWS = 10_000_000


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    rows_per_key: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner equi-join of many fact rows with one lookup row per key.

    Keys with more than ``hot_rows`` facts are split into parts by a hash of
    the row (a retried task splits them the same way), and their lookup row is
    repeated once per part. Copies of a whole row would share a part, so those
    of hot keys travel as one row with a count, which becomes rows again behind
    the join; facts with a column that cannot be compared (a map or variant) keep
    theirs. All other keys join as usual. ``rows_per_key`` (keys + ``n``) saves
    the counting pass when the caller has the counts already.
    """
    counts = rows_per_key if rows_per_key is not None else facts.groupBy(*keys).agg(
        F.count("*").alias("n")
    )
    hot = counts.filter(F.col("n") > hot_rows).select(
        *keys, F.ceil(F.col("n") / F.lit(hot_rows)).cast("int").alias("_parts")
    )
    parts = F.coalesce("_parts", F.lit(1))
    flat = [c for c, t in facts.dtypes if not t.startswith(("map", "array", "struct", "variant"))]
    row_part = F.pmod(F.xxhash64(*flat), parts).cast("int")
    marked = facts.join(F.broadcast(hot), keys, "left")
    comparable = not any("map<" in t or "variant" in t for _, t in facts.dtypes)
    if comparable:
        usual = marked.filter("_parts is null").withColumn("_copies", F.lit(1).cast("long"))
        often = marked.filter("_parts is not null").groupBy(*marked.columns)
        marked = usual.unionByName(often.agg(F.count("*").alias("_copies")))
    spread = marked.withColumn("_part", row_part)
    repeated = (
        lookup.join(F.broadcast(hot), keys, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_parts")
    )
    # Dealt by the part too, whatever the session lets the planner take as co-located.
    repeated = repeated.repartition(*keys, "_part")
    joined = spread.drop("_parts").join(repeated, [*keys, "_part"]).drop("_part")
    if comparable:
        joined = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        joined = joined.drop("_copy", "_copies")
    return joined

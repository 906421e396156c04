"""Connected components of an edge table, as joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import drop, keep


def _minima(pairs: DataFrame) -> DataFrame:
    """The smallest b of each a, beside every pair; a hub reaches a task as one row per task."""
    least = pairs.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("m"))
    return pairs.join(least, pairs["a"] == least["hub"]).drop("hub")


def _step(edges: DataFrame) -> DataFrame:
    """Edges hang from the smallest neighbour of their end points (large star, then small star)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = _minima(both).filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
    large = large.filter("a != b").distinct()
    small = _minima(large)
    return small.select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b"))))).filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that edges (a, b) reach, for every id in an edge but that itself.

    Each round hangs nodes from ever smaller ones, so long chains take a number of
    rounds that grows with the logarithm of their length. Rounds end when the edges
    no longer change; each is written to the shared folder.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    state, before = keep(edges, "edges"), None
    while True:
        mark = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before or mark[0] == 0:
            return state.select(F.col("a").alias("id"), F.col("b").alias("component"))
        state, old, before = keep(_step(state), "edges"), state, mark
        drop(old)

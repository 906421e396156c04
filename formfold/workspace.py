"""Shared working folders for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint root named by the cluster.

    The root is ``spark.checkpoint.dir``. Only a local session may go without
    one (tests): it gets a temporary folder, which a cluster must never use
    because executors on other machines cannot see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="formfold-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, by: list[str] = ()) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    For a derived dimension used by several joins: it is computed once, its
    size is known to the planner (so a small one is broadcast without shuffling
    the other side first), and a big one joins as a plain scan, whose skewed
    partitions adaptive execution can split. ``by`` columns become folders; with one
    such column (of few values) each folder is a read of its own, so a filter on it leaves the
    planner the size of that folder, not of the whole table.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    whole = spark.read.schema(df.schema).parquet(path)
    if len(by) != 1:
        return whole
    [column] = by
    values = [row[0] for row in whole.select(column).distinct().collect()]
    # other values have escaped folder names
    plain = [v for v in values if isinstance(v, str) and v.isascii() and v.isidentifier()]
    inside = StructType([f for f in df.schema if f.name != column])
    parts = [
        spark.read.schema(inside).parquet(f"{path}/{column}={v}").withColumn(column, F.lit(v)).select(df.columns)
        for v in plain
    ]
    if len(plain) < len(values) or not plain:
        parts.append(whole.filter(F.col(column).isNull() | ~F.col(column).isin(plain)))
    return reduce(DataFrame.unionByName, parts)

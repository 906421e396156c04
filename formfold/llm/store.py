"""Tables written to the shared folder, so that lineage is cut where executors can be lost."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; only a local session may go without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there."""
    path = shared_folder(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_numbered(df: DataFrame, label: str) -> DataFrame:
    """Keep ``df`` with two more columns, ``part`` and ``row``, bucketed by ``part``.

    ``row`` numbers the rows, ``part`` the tasks that wrote them, so a task's rows lie
    in one bucket and are written without a shuffle. Tables of rows can later be joined
    to this one on both columns: they alone are shuffled, by ``part``, which holds as
    many rows as one task read. For that the planner must take a join's rows as
    co-located when they are by some of its keys; the setting is made here.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    path, name = shared_folder(spark, label), f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = df.withColumn("row", F.monotonically_increasing_id()).withColumn("part", F.shiftright("row", 33))
    numbered.write.bucketBy(buckets, "part").options(path=path, compression="zstd").format("parquet").saveAsTable(name)
    # The frame reads the files from here on; the catalog needs no entry for that.
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def drop(*frames: DataFrame) -> None:
    """Delete kept tables that no later read needs."""
    for df in frames:
        jvm = df.sparkSession._jvm
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def names(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores behind it if the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted

"""A report kept by date, to which periods are added without reading what is there."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.plans.metrics import rollup_column

#: How a date stands in the name of its folder.
FOLDER, NAMES = "yyyy-MM-dd HH:mm:ss.SSSSSS", "rollup_on"


def write_rollup(new: DataFrame, path: str, merge: dict) -> str:
    """Write a period into a report of one folder per date; other dates' files stay as they are.

    The same result as ``rollup_merge`` on the previous report: dates of the new period
    replace their folders, and folders that fall out of the last ``rollupRange`` units of
    ``rollupAge`` before the newest date go. Rows without a date are left out. ``rollup`` 0 keeps
    the new period alone. Only names of folders are looked at, a list as long as the range.
    """
    spark = new.sparkSession
    name, letters = rollup_column(merge)
    date = F.to_timestamp(name, letters) if letters else F.col(name).cast("timestamp")
    rows = new.withColumn(NAMES, F.date_format(date, FOLDER)).filter(F.col(NAMES).isNotNull())
    keep_others = bool(merge.get("rollup"))
    (
        rows.hint("rebalance", NAMES).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if keep_others else "static")
        .partitionBy(NAMES).parquet(path)
    )
    if keep_others:
        _expire(spark, path, merge)
    return path


def read_rollup(spark: SparkSession, path: str, schema) -> DataFrame:
    """The report, with the columns that were written."""
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*schema.fieldNames())


def _expire(spark: SparkSession, path: str, merge: dict) -> None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {unquote(s.getPath().getName())[len(NAMES) + 1 :]: s.getPath() for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith(f"{NAMES}=")}
    if not found:
        return
    newest = F.to_timestamp(F.lit(max(found)), FOLDER)
    oldest = F.timestamp_add(merge["rollupAge"].upper(), F.lit(-merge["rollupRange"]), newest)
    limit = spark.range(1).select(F.date_format(oldest, FOLDER)).first()[0]
    for text, folder in found.items():
        if text <= limit:
            fs.delete(folder, True)

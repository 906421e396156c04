"""Report outputs. Every writer keeps the parallelism of the frame it is given."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.functions import slug

# Fixed value: folder text for a row without a program name.
UNNAMED = "ProgramName_notdefined"


def write_json(df: DataFrame, folder: str, name: str, mode: str = "overwrite", compression: str = "none") -> str:
    """JSON lines below ``folder/name``; ``mode="append"`` adds to it. Readers know compressed files by their names."""
    path = f"{folder}/{name}"
    df.write.mode(mode).option("compression", compression).json(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def split_write(
    df: DataFrame, columns: list[str], path: str, fmt: str = "csv", unnamed: str = UNNAMED
) -> str:
    """One folder per combination of names, in one job.

    Folder names are the slugs of the values. The rebalance hint gathers each
    combination into few files and splits a combination that is too big for one
    task, so a dominant program does not end in a single writer.
    """
    slugs = []
    for c in columns:
        df = df.na.fill(unnamed, subset=[c])
        name = f"{c.removesuffix('_name')}_slug"
        text = slug(c)
        df = df.withColumn(name, F.when(text == "", F.lit(slug_text(unnamed))).otherwise(text))
        slugs.append(name)
    out = df.hint("rebalance", *slugs).write.mode("overwrite").partitionBy(*slugs)
    if fmt == "csv":
        out = out.option("header", True)
    out.format(fmt).save(path)
    return path


def slug_text(text: str) -> str:
    return "_".join(text.lower().split())


def append_rows(df: DataFrame, path: str) -> str:
    """Append to a table folder; give it only new rows (see ``new_rows``)."""
    df.write.mode("append").parquet(path)
    return path


def publish(df: DataFrame, dims: list[str], ts: str, path: str, fmt: str = "parquet") -> str:
    """Declared dimensions plus a day partition; only the days present are replaced."""
    day = F.to_date(ts)
    out = df.select(*dims, F.col(ts), day.alias("day")).hint("rebalance", "day")
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .format(fmt)
        .save(path)
    )
    return path

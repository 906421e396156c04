"""A training-data pipeline over ``documents``: five stages, each written and read again.

Language identification, line deduplication, one document per group of near copies,
the mix of sources, and packing into sequences. Every stage works on all that the
stage before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from formfold.llm import langid, line_dedup, mixing, ngram_join, packing  # noqa: E402
from formfold.llm.store import keep  # noqa: E402

#: A document whose language is less certain than this, or that has none, goes.
LEAST_SCORE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled rows teach; text without letters goes."""
    model = langid.fit(langid.sample(docs.filter(~langid.held_out("doc_id"))))
    found = langid.identify(docs, model)
    label, score = found.columns[-2:]
    return found.filter((F.col(label) != langid.UND) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line equals or resembles go, and documents that lose all theirs."""
    found = line_dedup.dedup_lines(docs)
    kept = found.filter((F.col("n_lines") == 0) | (F.col("n_kept") > 0))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word n-grams resemble each other."""
    return ngram_join.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; documents repeat or go."""
    return mixing.mix(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each copy of a document goes."""
    return packing.pack(docs).drop("row")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("ngram_jaccard_join", near_duplicates),
    ("mixing", source_mix),
    ("best_fit_packing", sequence_packing),
]

#: SQL can express neither the trained model nor the seeded draws.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's rows written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

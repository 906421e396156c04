"""Evidence rows: one per answer with files, for observations and surveys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.functions import (
    app_name,
    evidence_files,
    item,
    join_array,
    total_evidences,
)
from formfold.operators import completed_only, dated_only, with_evidence

OBSERVATION_KEYS = {
    "observationSubmissionId": "_id",
    "entity": "entityId",
    "entityExternalId": "entityExternalId",
    "entityName": "entityInformation.name",
    "entityTypeId": "entityTypeId",
    "entityType": "entityType",
    "createdBy": "createdBy",
    "solutionExternalId": "solutionExternalId",
    "solutionId": "solutionId",
    "observationId": "observationId",
}
SURVEY_KEYS = {
    "surveySubmissionId": "_id",
    "createdBy": "createdBy",
    "solutionExternalId": "solutionExternalId",
    "solutionId": "solutionId",
    "surveyId": "surveyId",
}


def extract_evidence(
    submissions: DataFrame, keys: dict[str, str], default_app: str = "survey_app"
) -> DataFrame:
    """Answers with at least one file, names and paths joined with ','.

    Works on batch and streaming frames alike: no join and no shuffle.
    """
    subs = dated_only(completed_only(submissions))
    rows = subs.select(
        *[F.col(path).alias(alias) for alias, path in keys.items()],
        "completedDate",
        app_name("appInformation.appName", default_app).alias("appName"),
        total_evidences("answers").alias("total_evidences"),
        F.explode(F.map_values("answers")).alias("a"),
    ).filter(F.col("a.qid") != "")
    rows = rows.withColumn("_files", evidence_files(F.col("a")))
    return with_evidence(
        rows.select(
            *keys,
            "completedDate",
            "appName",
            "total_evidences",
            F.col("a.remarks").alias("remarks"),
            F.col("a.qid").alias("questionId"),
            F.col("a.qid").alias("questionExternalId"),
            item("a.payload.question", 0).alias("questionName"),
            F.col("a.responseType").alias("questionResponseType"),
            F.array_size("_files").alias("evidence_count"),
            join_array(F.col("_files.name")).alias("fileName"),
            join_array(F.col("_files.sourcePath")).alias("fileSourcePath"),
        )
    )


def observation_evidence(submissions: DataFrame, **options) -> DataFrame:
    return extract_evidence(submissions, OBSERVATION_KEYS, **options)


def survey_evidence(submissions: DataFrame, **options) -> DataFrame:
    return extract_evidence(submissions, SURVEY_KEYS, **options)

"""Reports handed out as they are: report rows of rubric observations under readable labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUBRIC = "observation_with_rubric"

# Column names and the labels they get.
_WHO = {
    "createdBy": "UUID",
    "role_title": "User Sub Type",
    "user_stateName": "Declared State",
    "user_districtName": "District",
    "user_blockName": "Block",
    "user_schoolUDISE_code": "School ID",
    "user_schoolName": "School Name",
    "organisation_name": "Org Name",
    "programName": "Program Name",
    "programExternalId": "Program ID",
    "solutionName": "Observation Name",
    "solutionExternalId": "Observation ID",
    "observationSubmissionId": "observation_submission_id",
    "domainName": "Domain Name",
}
DOMAIN_LABELS = {
    **_WHO,
    "domainLevel": "Domain Level",
    "childName": "Criteria Name",
    "level": "Criteria Level",
    "solutionId": "solutionId",
}
QUESTION_LABELS = {
    **_WHO,
    "sectionHeader": "Criteria Name",
    "questionExternalId": "Question_external_id",
    "questionName": "Question",
    "questionResponseLabel": "Question_response_label",
    "minScore": "Question score",
    "evidences": "Evidences",
    "remarks": "Remarks",
    "solutionId": "solutionId",
}


def labelled(rows: DataFrame, labels: dict[str, str], where: Column | None = None) -> DataFrame:
    """Distinct rows of the labelled columns, in the labels' order; columns the rows lack are left out."""
    rows = rows if where is None else rows.filter(where)
    there = [c for c in labels if c in rows.columns]
    return rows.select(*[F.col(c).alias(labels[c]) for c in there]).distinct()


def domain_report(answers: DataFrame) -> DataFrame:
    """Domains and criteria of rubric observations, from their answer rows."""
    return labelled(answers, DOMAIN_LABELS, F.col("solution_type") == RUBRIC)


def question_report(answers: DataFrame) -> DataFrame:
    """Questions and answers of rubric observations, from their answer rows."""
    return labelled(answers, QUESTION_LABELS, F.col("solution_type") == RUBRIC)


def handed_status(
    status: DataFrame, users: DataFrame, apps: list[str], labels: dict[str, str], **wanted: str
) -> DataFrame:
    """Status rows of known users of some apps, under labels.

    ``users`` has an ``id``; ``wanted`` are values that columns must have.
    """
    known = users.select(F.col("id").alias("user_id")).distinct()
    rows = status.filter(F.col("app_name").isin(apps)).join(known, "user_id", "left_semi")
    for column, value in wanted.items():
        rows = rows.filter(F.col(column) == value)
    return labelled(rows, labels)

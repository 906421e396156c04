"""Question dump: answers of selected programs, split into folders by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.functions import blank_to, item, join_array, last, value_text
from formfold.functions.numbers import NO_SCHOOL_GPS
from formfold.operators import explode_map, hierarchy, keep_known, with_name
from formfold.operators.joins import LEVELS


def question_dump(
    submissions: DataFrame,
    solutions: DataFrame,
    programs: DataFrame,
    wanted: DataFrame | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """One row per submission and answer; a submission without answers keeps one row.

    ``wanted`` holds the program ids to dump, joined once for all of them.
    """
    profile = F.col("userProfile")
    rows = submissions.select(
        F.col("_id").alias("submission_id"),
        F.col("solutionId").alias("solution_id"),
        F.col("programId").alias("program_id"),
        profile["userName"].alias("userName"),
        profile["userId"].alias("userId"),
        "completedDate",
        join_array(profile["framework"]["board"]).alias("board_name"),
        last(profile["organisations"])["orgName"].alias("organisation_name"),
        *[F.col(f"userRoleInformation.{lv}").alias(f"{lv}_externalId") for lv in LEVELS],
        "answers",
    )
    if wanted is not None:
        rows = keep_known(rows, wanted, "program_id")
    if keys is not None:
        rows = hierarchy(rows, keys)
    rows = with_name(rows, solutions, "solution_id", "solution_name")
    rows = rows.join(
        programs.select(F.col("_id").alias("program_id"), F.col("name").alias("program_name")),
        "program_id",
    )
    kept = [c for c in rows.columns if c != "answers"]
    return explode_map(rows, "answers", "_key", "a").select(
        *kept,
        F.col("a.qid").alias("qid"),
        F.col("a.responseType").alias("responseType"),
        item("a.payload.question", 0).alias("question"),
        value_text(F.col("a.payload.labels")).alias("labels"),
        blank_to("a.gpsLocation", NO_SCHOOL_GPS).alias("gpsLocation"),
        (F.coalesce(F.array_size("a.fileName"), F.lit(0)) == 0).alias("without_files"),
    )

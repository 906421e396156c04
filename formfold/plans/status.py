"""Observation status report and its metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.functions import (
    app_name,
    distinct_text,
    ecm_marked_na,
    flag_string,
    join_array,
    last,
    solution_type,
)
from formfold.operators import (
    LEVELS,
    distinct_report,
    explode_domain,
    fan_out_orgs,
    hierarchy,
    locations_to_columns,
    with_name,
)

# The dimensions and count names of the report.
DIMENSIONS = [
    "program_name",
    "program_id",
    "solution_name",
    "solution_id",
    "state_name",
    "state_externalId",
    "district_name",
    "district_externalId",
    "organisation_name",
    "organisation_id",
    "parent_channel",
    "solution_type",
    "private_program",
]
DOMAIN = ["domain_name", "domain_externalId", "domain_level"]
CRITERIA = ["criteria_name", "criteria_score", "criteria_id"]

COUNTS = {
    "unique_submissions": ("submission_id", None),
    "unique_entities": ("entity_id", None),
    "unique_users": ("user_id", None),
}


def location_keys(submissions: DataFrame) -> DataFrame:
    """Location lookup built from all users' own locations: (entity_type, key, id, name)."""
    entry = F.explode("userProfile.userLocations")
    return (
        submissions.select(entry.alias("l"))
        .select(
            F.col("l.type").alias("entity_type"),
            F.explode(F.array_distinct(F.array_compact(F.array("l.id", "l.code")))).alias("key"),
            F.struct(
                F.col("l.id").alias("entity_id"), F.col("l.name").alias("entity_name")
            ).alias("e"),
        )
        .groupBy("entity_type", "key")
        .agg(F.min("e").alias("e"))
        .select("entity_type", "key", "e.*")
    )


def status_report(
    submissions: DataFrame,
    solutions: DataFrame,
    programs: DataFrame,
    keys: DataFrame | None = None,
    require: list[str] = (),
    default_app: str = "survey_app",
    parent_channel: str | None = None,
    every_organisation: bool = False,
) -> DataFrame:
    """One row per submission with app, flags, user types, organisation and location names.

    The organisation is the last of the user's list, or with ``every_organisation``
    there is a row for each that is not a school (one with nulls if there is none).
    The counts below need the latter.

    ``keys`` (``location_keys`` or ``entity_keys``) resolves the user's location
    ids level by level; levels in ``require`` drop unmatched rows. Without it
    the user's own location array is used. Solution and program must exist.
    """
    profile = F.col("userProfile")
    org = last(profile["organisations"])
    columns = {
        "status": F.col("status"),
        "entity_externalId": F.col("entityExternalId"),
        "entity_id": F.col("entityId"),
        "entity_type": F.col("entityType"),
        "user_id": F.col("createdBy"),
        "solution_id": F.col("solutionId"),
        "solution_externalId": F.col("solutionExternalId"),
        "submission_id": F.col("_id"),
        "entity_name": F.col("entityInformation.name"),
        "completedDate": F.col("completedDate"),
        "program_id": F.col("programId"),
        "program_externalId": F.col("programExternalId"),
        "app_name": app_name("appInformation.appName", default_app),
        "private_program": flag_string("isAPrivateProgram", "true"),
        "solution_type": solution_type("isRubricDriven", "criteriaLevelReport"),
        "ecm_marked_na": ecm_marked_na("evidencesStatus"),
        "updatedAt": F.col("updatedAt"),
        "role_title": F.col("userRoleInformation.role"),
        "channel": profile["rootOrgId"],
        "parent_channel": F.lit(parent_channel).cast("string"),
        "board_name": join_array(profile["framework"]["board"]),
        "user_type": distinct_text(profile["profileUserTypes"]["type"]),
        "themes": F.col("themes"),
        "criteria": F.col("criteria"),
        "_located": profile["userLocations"],
    }
    if every_organisation:
        columns["_organisations"] = profile["organisations"]
    else:
        columns |= {"organisation_name": org["orgName"], "organisation_id": org["organisationId"]}
    if keys is not None:
        columns |= {f"{lv}_externalId": F.col(f"userRoleInformation.{lv}") for lv in LEVELS}
    rows = submissions.select(*[c.alias(name) for name, c in columns.items()])
    if keys is None:
        rows = locations_to_columns(rows, "_located")
    else:
        rows = hierarchy(rows, keys, require=require, by=["submission_id"])
    rows = with_name(rows.drop("_located"), solutions, "solution_id", "solution_name")
    rows = with_name(rows, programs, "program_id", "program_name")
    if every_organisation:
        rows = fan_out_orgs(rows, "_organisations").drop("_organisations")
    return rows


def status_counts(report: DataFrame) -> DataFrame:
    """Submissions, entities and users per status."""
    return distinct_report(report, [*DIMENSIONS, "status"], COUNTS)


def domain_counts(report: DataFrame, by_criteria: bool = False) -> DataFrame:
    """The same counts per domain (and criterion) of completed rubric observations."""
    rubric = report.filter(
        (F.col("status") == "completed") & (F.col("solution_type") == "observation_with_rubric")
    )
    dims = [*DIMENSIONS, *DOMAIN, *(CRITERIA if by_criteria else [])]
    return distinct_report(explode_domain(rubric), dims, COUNTS)


def form_metrics(submissions: DataFrame, names: DataFrame) -> DataFrame:
    """Submitting users, submissions, starting users and entities per program, solution, district.

    ``submissions`` has program_name, solution_name, district, status,
    submission_id, createdBy and entityId; ``names`` maps district to
    district_name.
    """
    located = submissions.join(names, "district", "left")
    done, started = F.col("status") == "completed", F.col("status") == "started"
    return distinct_report(
        located,
        ["program_name", "solution_name", "district_name"],
        {
            "Unique Users who submitted form": ("createdBy", done),
            "Total submissions": ("submission_id", done),
            "Unique Users who started form": ("createdBy", started),
            "Total entities observed": ("entityId", done),
        },
    )

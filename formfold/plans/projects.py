"""Project report rows and their distinct-count metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.functions import (
    completed_date,
    distinct_text,
    evidence_status,
    flag_string,
    join_array,
    one_line,
    project_created_type,
    project_title,
)
from formfold.operators import (
    LEVELS,
    categories_text,
    distinct_report,
    explode_task_rows,
    fan_out_orgs,
    hierarchy,
    locations_to_columns,
    project_evidence,
    task_rows,
)

# The dimensions of the report.
DIMENSIONS = [
    "program_name",
    "program_id",
    "project_title",
    "solution_id",
    "status_of_project",
    "state_name",
    "state_externalId",
    "district_name",
    "district_externalId",
    "organisation_name",
    "organisation_id",
    "private_program",
    "project_created_type",
    "parent_channel",
]
PROGRAM_DIMENSIONS = [
    "program_name",
    "program_id",
    "status_of_project",
    "state_name",
    "state_externalId",
    "private_program",
    "project_created_type",
    "parent_channel",
]


def project_report(
    projects: DataFrame,
    evidence_base: str = "",
    parent_channel: str | None = None,
    entities: DataFrame | None = None,
    per_task: bool = True,
) -> DataFrame:
    """One row per (project, task, attachment or sub-task, organisation).

    With ``per_task=False`` a row per (project, organisation) that tells whether any
    of those rows has evidence, which is all that the counts need.

    Location names come from the user's profile or, when ``entities`` (see
    ``entity_keys``) is given, from the entity found by the user's location ids.
    Everything about the project as a whole is computed before its tasks are
    exploded, and so are its organisations. Nothing here shuffles except entity lookups too big to broadcast:
    rows of a project are built, merged and fanned out inside the project's row.
    """
    profile = F.col("userProfile")
    columns = {
        "project_id": F.col("_id"),
        "project_created_type": project_created_type("projectTemplateId"),
        "project_title": project_title("solutionInformation.name", "title"),
        "project_title_editable": F.col("title"),
        "program_id": F.col("programId"),
        "program_externalId": F.col("programExternalId"),
        "program_name": one_line("programInformation.name"),
        "project_duration": F.col("metaInformation.duration"),
        "project_last_sync": F.col("syncedAt"),
        "project_updated_date": F.col("updatedAt"),
        "project_deleted_flag": flag_string("isDeleted"),
        "area_of_improvement": categories_text("categories"),
        "status_of_project": F.col("status"),
        "createdBy": F.col("userId"),
        "project_description": F.col("description"),
        "project_goal": one_line("metaInformation.goal"),
        "parent_channel": F.lit(parent_channel).cast("string"),
        "project_created_date": F.col("createdAt"),
        "private_program": flag_string("isAPrivateProgram", "true"),
        "project_terms_and_condition": flag_string("hasAcceptedTAndC"),
        "project_completed_date": completed_date("status", "updatedAt"),
        "solution_id": F.col("solutionInformation._id"),
        "designation": F.col("userRoleInformation.role"),
        "channel": profile["rootOrgId"],
        "board_name": join_array(profile["framework"]["board"]),
        "user_type": distinct_text(profile["profileUserTypes"]["type"]),
        "certificate_id": F.col("certificate.osid"),
        "certificate_status": F.col("certificate.status"),
        "certificate_date": F.col("certificate.issuedOn"),
    }
    nested = {
        "tasks": F.col("tasks"),
        "attachments": F.col("attachments"),
        "remarks": F.col("remarks"),
        "_organisations": profile["organisations"],
    }
    if entities is None:
        located = {"_locations": profile["userLocations"]}
    else:
        located = {f"{lv}_externalId": F.col(f"userRoleInformation.{lv}") for lv in LEVELS}
    flat = projects.select(
        *[c.alias(name) for name, c in (columns | nested | located).items()]
    )
    if entities is None:
        flat = locations_to_columns(flat, "_locations").drop("_locations")
    else:
        flat = hierarchy(flat, entities, by=["project_id"])
    if not per_task:
        evidence = F.coalesce(project_evidence("tasks", "attachments"), F.lit(False))
        flat = flat.withColumn("evidence_status", evidence)
        return fan_out_orgs(flat.drop("tasks", "attachments", "remarks"), "_organisations").drop("_organisations")
    fanned = fan_out_orgs(task_rows(flat, evidence_base), "_organisations").drop("_organisations")
    has_evidence = evidence_status("project_has_evidence", "task_evidence_status")
    rows = explode_task_rows(fanned).withColumn("evidence_status", has_evidence).drop("project_has_evidence")
    last = ["organisation_id", "organisation_name", "evidence_status"]
    return rows.select(*[c for c in rows.columns if c not in last], *last)


def project_counts(report: DataFrame, dims: list[str] = DIMENSIONS) -> DataFrame:
    """Projects, users, certificates and submitted projects with evidence per group.

    Of ``project_report``; rows without tasks (``per_task=False``) give the same counts
    for less.
    """
    with_evidence = F.col("evidence_status") & (F.col("status_of_project") == "submitted")
    return distinct_report(
        report,
        dims,
        {
            "no_of_certificate_issued": ("project_id", F.col("certificate_status") == "active"),
            "unique_projects": ("project_id", None),
            "unique_users": ("createdBy", None),
            "no_of_imp_with_evidence": ("project_id", with_evidence),
        },
    )

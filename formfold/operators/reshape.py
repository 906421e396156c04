"""Nested documents to flat rows, and back.

Everything that belongs to one document is done inside its row with array and
map functions; only ``melt``/``pivot`` and lookups move data between tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formfold.functions import (
    as_column,
    distinct_structs,
    flag_string,
    non_school_orgs,
    one_line,
)

from .joins import LEVELS

__all__ = [
    "categories_text",
    "entity_columns",
    "explode_domain",
    "explode_map",
    "explode_roles",
    "explode_rows",
    "explode_task_rows",
    "fan_out_orgs",
    "project_evidence",
    "fan_out_roles",
    "flatten_tasks",
    "locations_to_columns",
    "melt",
    "metric_slots",
    "pivot",
    "task_rows",
]


def melt(
    df: DataFrame,
    id_vars: list[str],
    value_vars: list[str],
    var_name: str = "variable",
    value_name: str = "value",
) -> DataFrame:
    """Wide to long. Nested value columns must be selected under a flat name first."""
    return df.unpivot(id_vars, value_vars, var_name, value_name)


def pivot(
    df: DataFrame, keys: list[str], column: str, names: list, aggregates: list[Column]
) -> DataFrame:
    """Long to wide with a fixed list of values, so the result schema is fixed."""
    return df.groupBy(*keys).pivot(column, names).agg(*aggregates)


def explode_rows(df: DataFrame, array: str, alias: str) -> DataFrame:
    """One row per element; an empty or missing array keeps one row."""
    return df.withColumn(alias, F.explode_outer(array))


def explode_map(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """One row per map entry; an empty or missing map keeps one row."""
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.explode_outer(column).alias(key, value))


def categories_text(categories: Column | str, sep: str = ", ") -> Column:
    """Category names of a document as one text."""
    return one_line(F.concat_ws(sep, as_column(categories)["name"]))


def _evidence(attachment: Column) -> Column:
    """Name of a link, stored path of anything else with a type."""
    kind = attachment["type"]
    return F.when(kind == "link", attachment["name"]).when(
        kind.isNotNull(), attachment["sourcePath"]
    )


def _prefixed(attachment: Column, base: str) -> Column:
    path = _evidence(attachment)
    return F.when(attachment["type"] != "link", F.concat(F.lit(base), path)).otherwise(path)


def _length(arr: Column) -> Column:
    return F.coalesce(F.array_size(arr), F.lit(0))


def _task_rows(task: Column, base: str) -> Column:
    """Rows of one task: attachment i beside sub-task i, at least one row."""
    attachments, children = task["attachments"], task["children"]
    n = F.greatest(_length(attachments), _length(children), F.lit(1))

    def row(i: Column) -> Column:
        child = F.get(children, i)
        has_child = i < _length(children)
        text = F.coalesce
        return F.struct(
            task["_id"].alias("task_id"),
            one_line(task["name"]).alias("tasks"),
            flag_string(task["isDeleted"]).alias("task_deleted_flag"),
            (_length(attachments) > 0).alias("task_evidence_status"),
            text(task["assignee"], F.lit("")).alias("task_assigned_to"),
            text(task["startDate"], F.lit("")).alias("task_start_date"),
            text(task["endDate"], F.lit("")).alias("task_end_date"),
            task["syncedAt"].alias("tasks_date"),
            text(task["status"], F.lit("")).alias("tasks_status"),
            _prefixed(F.get(attachments, i), base).alias("task_evidence"),
            F.when(i == 0, one_line(task["remarks"])).alias("task_remarks"),
            child["_id"].alias("sub_task_id"),
            one_line(child["name"]).alias("sub_task"),
            child["status"].alias("sub_task_status"),
            child["syncedAt"].alias("sub_task_date"),
            F.when(has_child, text(child["startDate"], F.lit(""))).alias("sub_task_start_date"),
            child["endDate"].alias("sub_task_end_date"),
            flag_string(child["isDeleted"]).alias("sub_task_deleted_flag"),
        )

    return F.transform(F.sequence(F.lit(0), n - 1), row)


def flatten_tasks(df: DataFrame, base: str = "") -> DataFrame:
    """One row per (project, task, attachment or sub-task).

    Within a task, attachment i and sub-task i share a row and the task's
    remarks stand on its first row. The project's own attachments run alongside
    the resulting rows by position and its remarks stand on the first row. If
    there are more project attachments than rows, the rest get rows of their
    own, so no evidence is lost. Equal rows of one project are merged inside the
    row, which removes the need for a distinct over the whole output.

    ``project_has_evidence`` tells whether the project has attachments itself.
    """
    return explode_task_rows(task_rows(df, base))


def task_rows(df: DataFrame, base: str = "") -> DataFrame:
    """The rows of ``flatten_tasks`` as an array ``_rows`` of their project.

    What else repeats a project (its organisations) goes between this and
    ``explode_task_rows``: it then repeats projects, not the wide rows of their tasks.
    """
    tasks = F.flatten(
        F.transform(F.coalesce("tasks", F.array()), lambda t: _task_rows(t, base))
    )
    attachments = F.col("attachments")
    staged = df.withColumns(
        {"_task_rows": tasks, "project_has_evidence": _length(attachments) > 0}
    )
    own = F.when(F.col("remarks").isNotNull(), 1).otherwise(0)
    n = F.greatest(_length(F.col("_task_rows")), _length(attachments), own)

    def row(i: Column) -> Column:
        return F.struct(
            F.get("_task_rows", i).alias("t"),
            _prefixed(F.get(attachments, i), base).alias("project_evidence"),
            F.when(i == 0, one_line(F.col("remarks"))).alias("project_remarks"),
        )

    indexes = F.when(n > 0, F.sequence(F.lit(0), n - 1))
    kept = [c for c in df.columns if c not in ("tasks", "attachments", "remarks")]
    return staged.withColumn("_rows", F.transform(indexes, row)).select(
        *kept, "project_has_evidence", distinct_structs("_rows").alias("_rows")
    )


def explode_task_rows(df: DataFrame) -> DataFrame:
    """One row per entry of ``task_rows``; a project without any keeps one row."""
    kept = [c for c in df.columns if c != "_rows"]
    rows = df.withColumn("_row", F.explode_outer("_rows"))
    flat = rows.select(*kept, "_row.t.*", "_row.project_evidence", "_row.project_remarks")
    return flat.na.fill("false", ["task_deleted_flag", "sub_task_deleted_flag"])


def project_evidence(tasks: str, attachments: str) -> Column:
    """Whether a row of the project's tasks has evidence: its own or the project's; a project without tasks has none."""
    own = _length(F.col(attachments)) > 0
    return F.exists(tasks, lambda t: own | (_length(t["attachments"]) > 0))


def explode_domain(df: DataFrame) -> DataFrame:
    """Themes and their criteria matched to the scored criteria of the submission.

    A criterion belongs to a theme when the theme names its id or its parent's
    id. Themes without any scored criterion keep one row.
    """
    themed = df.withColumn("_theme", F.explode_outer("themes"))
    ids = F.coalesce(F.col("_theme.criteria.criteriaId"), F.array())
    scored = F.filter(
        "criteria",
        lambda c: F.coalesce(F.array_contains(ids, c["_id"]), F.lit(False))
        | F.coalesce(F.array_contains(ids, c["parentCriteriaId"]), F.lit(False)),
    )
    kept = [c for c in df.columns if c not in ("themes", "criteria")]
    return themed.withColumn("_criterion", F.explode_outer(scored)).select(
        *kept,
        F.col("_theme.name").alias("domain_name"),
        F.col("_theme.externalId").alias("domain_externalId"),
        F.col("_theme.pointsBasedLevel").alias("domain_level"),
        F.col("_criterion._id").alias("criteria_id"),
        F.col("_criterion.name").alias("criteria_name"),
        F.col("_criterion.score").alias("criteria_score"),
    )


def fan_out_orgs(df: DataFrame, organisations: Column | str) -> DataFrame:
    """One row per non-school organisation, or one row with nulls."""
    return df.withColumn("_org", F.explode_outer(non_school_orgs(organisations))).select(
        *df.columns,
        F.col("_org.org_id").alias("organisation_id"),
        F.col("_org.org_name").alias("organisation_name"),
    )


def fan_out_roles(df: DataFrame, roles: Column | str) -> DataFrame:
    """One row per distinct role struct, its fields as columns."""
    taken = [c for c in df.columns if c != roles]
    rows = df.withColumn("_role", F.explode_outer(distinct_structs(roles)))
    names = [f.name for f in rows.schema["_role"].dataType.fields if f.name not in taken]
    return rows.select(*taken, *[F.col(f"_role.{n}").alias(n) for n in names])


def locations_to_columns(
    df: DataFrame, locations: Column | str, levels: list[str] = LEVELS
) -> DataFrame:
    """``<level>_name``, ``<level>_externalId`` and ``<level>_code`` from a typed array.

    The first entry of a type counts. No grouping and no pivot: the array is
    searched in place.
    """
    def first_of(level: str) -> Column:
        return F.get(F.filter(as_column(locations), lambda x: x["type"] == level), F.lit(0))

    added = {}
    for level in levels:
        entry = first_of(level)
        added[f"{level}_name"] = entry["name"]
        added[f"{level}_externalId"] = entry["id"]
        added[f"{level}_code"] = entry["code"]
    return df.withColumns(added)


def explode_roles(df: DataFrame, user: str = "userId", roles: str = "roles") -> DataFrame:
    """User x role x entity; a role without entities keeps one row with a null entity.

    ``roles`` is array<struct<roleId, code, entities:array<string>>>; users
    without roles do not appear.
    """
    per_role = df.select(user, F.explode(roles).alias("_r"))
    return per_role.select(
        user,
        F.col("_r.roleId").alias("roleId"),
        F.col("_r.code").alias("roleCode"),
        F.explode_outer("_r.entities").alias("entityId"),
    )


def entity_columns(
    df: DataFrame, types: list[str], kind: str, entity_id: str, name: str, external_id: str
) -> DataFrame:
    """``<type>``, ``<type>Name`` and ``<type>ExternalId``, filled for the row's own type."""
    added = {}
    for t in types:
        own = F.col(kind) == t
        added[t] = F.when(own, F.col(entity_id))
        added[f"{t}Name"] = F.when(own, F.col(name))
        added[f"{t}ExternalId"] = F.when(own, F.col(external_id))
    return df.withColumns(added)


def metric_slots(df: DataFrame, stats: str, names: str, slots: int = 9) -> DataFrame:
    """Values of the named metrics in slots m1..mN; null names are skipped.

    ``stats`` is a map of metric values, ``names`` an array of metric names. A row
    with more names than slots is an error, never cut.
    """
    given = F.array_compact(names)
    too_many = F.raise_error(F.lit(f"more than {slots} metrics in a row"))
    present = F.when(F.size(given) > slots, too_many).otherwise(given)
    added = {
        f"m{i}": F.try_element_at(F.col(stats), F.get(present, F.lit(i - 1)))
        for i in range(1, slots + 1)
    }
    return df.withColumns(added)

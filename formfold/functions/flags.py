"""Report flags and case expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import as_column
from .text import one_line

__all__ = [
    "app_name",
    "completed_date",
    "const",
    "evidence_status",
    "first_option",
    "flag_string",
    "project_created_type",
    "project_title",
    "solution_type",
    "typed_null",
]

# Labels that report consumers compare against.
FROM_LIBRARY = "project imported from library"
USER_CREATED = "user created project"
WITH_RUBRIC = "observation_with_rubric"
WITHOUT_RUBRIC = "observation_with_out_rubric"
SUBMITTED = "submitted"


def flag_string(c: Column | str, default: str = "false") -> Column:
    """Boolean as 'true'/'false' text, with a default for null."""
    return F.coalesce(as_column(c).cast("string"), F.lit(default))


def project_created_type(template_id: Column | str) -> Column:
    return F.when(as_column(template_id).isNotNull(), FROM_LIBRARY).otherwise(USER_CREATED)


def solution_type(is_rubric: Column | str, level_report: Column | str) -> Column:
    """Rubric only when both flags are true; null counts as false."""
    both = as_column(is_rubric) & as_column(level_report)
    return F.when(both, WITH_RUBRIC).otherwise(WITHOUT_RUBRIC)


def project_title(solution_name: Column | str, title: Column | str) -> Column:
    return one_line(F.coalesce(as_column(solution_name), as_column(title)))


def completed_date(status: Column | str, updated_at: Column | str) -> Column:
    """Update time of submitted records, null for the others."""
    return F.when(as_column(status) == SUBMITTED, as_column(updated_at))


def app_name(c: Column | str, default: str) -> Column:
    return F.coalesce(F.lower(as_column(c)), F.lit(default))


def const(v) -> Column:
    return F.lit(v)


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def first_option(c: Column | str, names: list[str]) -> Column:
    """1-based number of the first field among ``names`` that is not null."""
    c = as_column(c)
    present = [F.when(c[name].isNotNull(), F.lit(i)) for i, name in enumerate(names, 1)]
    return F.coalesce(*present)


def evidence_status(project: Column | str, task: Column | str) -> Column:
    """True when project or task holds evidence; unknown on either side is false."""
    project, task = as_column(project), as_column(task)
    known = project.isNotNull() & task.isNotNull()
    return F.when(known, project | task).otherwise(False)

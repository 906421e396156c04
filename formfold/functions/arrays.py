"""Array and map expressions. All run inside the row: no explode, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_column",
    "distinct_list",
    "distinct_structs",
    "ecm_marked_na",
    "evidence_files",
    "item",
    "last",
    "level_label",
    "n_items",
    "non_school_orgs",
    "sequence_number",
    "sum_fields",
    "total_evidences",
]


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def last(arr: Column | str) -> Column:
    """Last element, null for an empty or missing array."""
    return F.try_element_at(as_column(arr), F.lit(-1))


def item(arr: Column | str, i: int = 0) -> Column:
    """Element at a 0-based position, null when out of range."""
    return F.get(as_column(arr), F.lit(i))


def n_items(arr: Column | str) -> Column:
    """Array length; a missing array counts 0."""
    return F.coalesce(F.array_size(as_column(arr)), F.lit(0))


def distinct_list(arr: Column | str) -> Column:
    """Ordered de-duplication."""
    return F.array_distinct(as_column(arr))


def distinct_structs(arr: Column | str) -> Column:
    """De-duplication of an array of structs, given as a column (it is read thrice).

    Comparing structs pairwise is slow, so their hashes are compared first: only
    when two hashes agree can there be a repeat, and the exact comparison runs.
    """
    arr = as_column(arr)
    hashes = F.transform(arr, lambda x: F.xxhash64(x))
    may_repeat = F.array_size(F.array_distinct(hashes)) < F.array_size(arr)
    return F.when(may_repeat, F.array_distinct(arr)).otherwise(arr)


def ecm_marked_na(evidences_status: Column | str) -> Column:
    """Names of evidence methods marked not applicable, each followed by ';'."""
    marked = F.filter(as_column(evidences_status), lambda e: e["notApplicable"])
    return F.array_join(F.transform(marked, lambda e: F.concat(e["name"], F.lit(";"))), "")


def sequence_number(sequence: Column, method: Column, section: Column, external_id: Column) -> Column:
    """1-based place of a question in ``sequence[method][section]``; null if absent."""
    ordered = F.try_element_at(F.try_element_at(sequence, method), section)
    return F.nullif(F.array_position(ordered, external_id), F.lit(0))


def level_label(levels: Column, score: Column) -> Column:
    """Label of the rubric level whose ``level`` equals the score (last match)."""
    hits = F.filter(F.map_values(levels), lambda lv: lv["level"] == score)
    return last(hits)["label"]


def sum_fields(arr: Column | str, *fields: str) -> Column:
    """Sum of the named fields of every struct in an array."""
    def add(total: Column, x: Column) -> Column:
        for f in fields:
            total = total + F.coalesce(x[f].cast("bigint"), F.lit(0).cast("bigint"))
        return total

    return F.aggregate(
        F.coalesce(as_column(arr), F.array()), F.lit(0).cast("bigint"), add
    )


def non_school_orgs(organisations: Column | str) -> Column:
    """Organisations that are not schools, as (org_id, org_name), without repeats.

    An organisation without the flag counts as a non-school one.
    """
    kept = F.filter(
        as_column(organisations), lambda o: ~F.coalesce(o["isSchool"], F.lit(False))
    )
    return F.array_distinct(
        F.transform(
            kept,
            lambda o: F.struct(
                o["organisationId"].alias("org_id"), o["orgName"].alias("org_name")
            ),
        )
    )


def evidence_files(answer: Column) -> Column:
    """Files of an answer: ``fileName`` if the field is there, else all instance files."""
    return F.coalesce(answer["fileName"], F.flatten(answer["instanceFileName"]))


def total_evidences(answers: Column | str) -> Column:
    """Number of files over all answers of a submission."""
    return F.aggregate(
        F.map_values(as_column(answers)),
        F.lit(0),
        lambda n, a: n + F.coalesce(F.array_size(evidence_files(a)), F.lit(0)),
    )

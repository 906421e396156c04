"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import as_column

__all__ = [
    "blank_to",
    "distinct_text",
    "evidence_url",
    "evidence_urls",
    "join_array",
    "join_lines",
    "one_line",
    "slug",
    "strip_pattern",
    "suffix",
    "urn_id",
]


def one_line(c: Column | str) -> Column:
    return F.replace(as_column(c), F.lit("\n"), F.lit(" "))


def join_lines(c: Column | str) -> Column:
    """Lines joined with a space before each, so the text starts with a blank."""
    return F.concat(F.lit(" "), one_line(c))


def join_array(arr: Column | str, sep: str = ",") -> Column:
    return F.concat_ws(sep, as_column(arr))


def distinct_text(arr: Column | str, sep: str = ",") -> Column:
    return F.concat_ws(sep, F.array_distinct(as_column(arr)))


def suffix(c: Column | str, s: str) -> Column:
    return F.concat(as_column(c), F.lit(s))


def strip_pattern(c: Column | str, pattern: str) -> Column:
    return F.regexp_replace(as_column(c), pattern, "")


def blank_to(c: Column | str, text: str) -> Column:
    """Empty or missing text to a default text."""
    return F.coalesce(F.nullif(as_column(c), F.lit("")), F.lit(text))


def urn_id(c: Column | str) -> Column:
    """Last part of a colon-separated resource name."""
    return F.substring_index(as_column(c), ":", -1)


def slug(c: Column | str) -> Column:
    """Lower-cased words joined with '_'."""
    return F.regexp_replace(F.lower(F.regexp_replace(as_column(c), r"^\s+|\s+$", "")), r"\s+", "_")


def evidence_url(evidence: Column, kind: Column, base: str) -> Column:
    """Stored files get the base address; links (and unknown kinds) stay as they are."""
    return F.when(kind != "link", F.concat(F.lit(base), evidence)).otherwise(evidence)


def evidence_urls(files: Column | str, base: str, sep: str = " , ") -> Column:
    """Addresses of all files of an answer; null when there is no file."""
    files = as_column(files)
    joined = F.array_join(
        F.transform(files, lambda f: F.concat(F.lit(base), f["sourcePath"])), sep
    )
    return F.when(F.size(files) > 0, joined)

"""Time expressions. The session zone is UTC; zones are named where they matter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import as_column

__all__ = [
    "date_part",
    "ms_to_date",
    "ms_to_time",
    "ms_to_ts",
    "time_part",
]


def ms_to_ts(c: Column | str, zone: str | None = None) -> Column:
    """Epoch milliseconds (number or text) to a timestamp.

    With ``zone`` the milliseconds count wall time of that zone, and the result
    is moved to UTC.
    """
    ts = F.timestamp_millis(as_column(c).cast("bigint"))
    return F.to_utc_timestamp(ts, zone) if zone else ts


def ms_to_date(c: Column | str) -> Column:
    return F.date_format(ms_to_ts(c), "yyyy-MM-dd")


def ms_to_time(c: Column | str) -> Column:
    return F.date_format(ms_to_ts(c), "HH:mm:ss")


def date_part(c: Column | str) -> Column:
    """Part of an ISO text before 'T'."""
    return F.get(F.split(as_column(c), "T"), F.lit(0))


def time_part(c: Column | str) -> Column:
    """Part of an ISO text after 'T', null when there is none."""
    return F.get(F.split(as_column(c), "T"), F.lit(1))

"""Time bounds that also leave out the day folders of a stored reading table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skygauge.functions.times import is_instant, utc_day

PERIOD = "period"
READING_TIME = "timestamp"


def _kept_by_day(df: DataFrame, time: str) -> bool:
    """True for a stored reading table: its periods are the UTC days of the reading time."""
    return time == READING_TIME and PERIOD in df.columns


def from_time(df: DataFrame, time: str, bound: Column, included: bool = True) -> DataFrame:
    """Rows from ``bound`` on. The bound may be a scalar subquery: folders are then left out at run time."""
    rows = df.filter(F.col(time) >= bound if included else F.col(time) > bound)
    if _kept_by_day(df, time):
        rows = rows.filter(F.col(PERIOD) >= utc_day(bound, is_instant(df, time)))
    return rows


def between_times(df: DataFrame, time: str, start: Column, end: Column) -> DataFrame:
    """Rows from ``start`` to ``end``, both included."""
    rows = df.filter(F.col(time).between(start, end))
    if _kept_by_day(df, time):
        instant = is_instant(df, time)
        rows = rows.filter(F.col(PERIOD).between(utc_day(start, instant), utc_day(end, instant)))
    return rows


def newest_day(df: DataFrame, time: str) -> DataFrame:
    """Rows among which the newest time is: of a stored reading table those of its last day, else all.

    The last day is found from the names of the folders and the row counts in the files' footers; no column is read.
    """
    if not _kept_by_day(df, time):
        return df
    return df.filter(F.col(PERIOD) == df.agg(F.max(PERIOD)).scalar())

"""A data-skipping index: for each period of a table the least and greatest value of its other clocks.

A reading table is kept by the day of the reading time, and panels ask by recording or processing time. The index has
one row per period. It is widened before rows are stored, so that it always covers them; it never narrows, which may
open a folder too many and leaves none out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skygauge.operators.pruning import PERIOD
from skygauge.sources.snapshots import next_version, read_snapshot, write_snapshot
from skygauge.sources.tables import read_table, table_exists

CLOCKS = ("recorded_at", "processed_at")


def ranges_path(path: str) -> str:
    return path + "__ranges"


def _ranges(rows: DataFrame, clocks: Sequence[str]) -> DataFrame:
    return rows.groupBy(PERIOD).agg(*[f(c).alias(f"{name}_{c}") for c in clocks for name, f in (("low", F.min), ("high", F.max))])


def widen_ranges(rows: DataFrame, path: str, version: int | None = None, clocks: Sequence[str] = CLOCKS) -> None:
    """Cover ``rows`` (with their ``period``) that are about to be stored at ``path``.

    A table that was written without an index is read once, so that its older rows are covered too. Without a
    ``version`` the next one is written.
    """
    spark, index = rows.sparkSession, ranges_path(path)
    clocks = [c for c in clocks if c in rows.columns]
    if not clocks:
        return
    version = next_version(spark, index) if version is None else version
    known = read_snapshot(spark, index, before=version)
    both = _ranges(rows, clocks)
    if known is not None:
        both = known.unionByName(both, allowMissingColumns=True)
    elif table_exists(spark, path):
        stored = read_table(spark, path)
        both = both.unionByName(_ranges(stored, [c for c in clocks if c in stored.columns]), allowMissingColumns=True)
    bounds = [c for c in both.columns if c != PERIOD]
    merged = both.groupBy(PERIOD).agg(*[(F.min if c.startswith("low_") else F.max)(c).alias(c) for c in bounds])
    write_snapshot(merged, index, version)


def periods_between(spark: SparkSession, path: str, clock: str, start: Column, end: Column | None = None) -> list | None:
    """Periods that can hold rows with ``start <= clock <= end``; None if the index doesn't know the clock.

    One value for each day at most, so the list is bounded by the span of the calendar.
    """
    index = read_snapshot(spark, ranges_path(path))
    if index is None or f"low_{clock}" not in index.columns:
        return None
    inside = F.col(f"high_{clock}") >= start
    if end is not None:
        inside = inside & (F.col(f"low_{clock}") <= end)
    return sorted(r[0] for r in index.filter(inside).select(PERIOD).collect())


def read_between(spark: SparkSession, path: str, clock: str, start: Column, end: Column | None = None) -> DataFrame:
    """Rows of a stored table with ``start <= clock <= end``; only the folders that can hold some are opened."""
    rows = read_table(spark, path)
    wanted = F.col(clock) >= start if end is None else F.col(clock).between(start, end)
    periods = periods_between(spark, path, clock, start, end)
    if periods is None:
        return rows.filter(wanted)
    return rows.filter(F.col(PERIOD).isin(periods) & wanted) if periods else rows.filter(wanted).filter(F.lit(False))


def newest_value(spark: SparkSession, path: str, clock: str) -> Column | None:
    """The greatest value of a clock, from the index alone, as a scalar subquery; it may exceed that of rows
    deleted since. None if the index doesn't know the clock."""
    index = read_snapshot(spark, ranges_path(path))
    if index is None or f"high_{clock}" not in index.columns:
        return None
    return index.agg(F.max(f"high_{clock}").alias("newest")).scalar()

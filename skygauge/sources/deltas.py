"""Keyed tables that are merged when they are read.

Each load adds a small delta below the days of its rows, and nothing stored is read or written for it. A reader puts
the deltas of a day together and takes the newest row of each key; a day that one load wrote, or that was compacted,
is read as it is. So a late hour costs one small file, where ``tables.upsert_table`` rewrites its period.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skygauge.operators.keyed import latest_per_key
from skygauge.operators.pruning import PERIOD
from skygauge.sources.ranges import periods_between
from skygauge.sources.tables import (BATCH, append_batch, compact_days, folder_names, read_table, table_exists, with_keys)


def upsert_delta(updates: DataFrame, path: str, load_id: int, keys: Sequence[str], order_by: Sequence[str],
                 time_column: str) -> None:
    """Insert or replace rows by key, as a delta with the number ``load_id`` (0 or more).

    The newest row of a key by ``order_by`` counts, stored or new; of equal order the one with the greater number.
    A load that comes again under its number replaces its own rows. Use each number once, and none again after its
    days were compacted. ``time_column`` must be part of the key or determined by it; a row without it, or
    without a part of the key, is an error. New columns may come with any load, and are NULL in rows without them.
    """
    if load_id < 0:
        raise ValueError("numbers below 0 are those of compacted loads")
    rows = with_keys(updates, [*keys, time_column])
    append_batch(latest_per_key(rows, keys, order_by), path, load_id, time_column, keys)


def open_days(spark: SparkSession, path: str) -> list[date]:
    """Days with rows of several loads, by the names of folders; at most one for each day of the calendar."""
    def loads(day: str) -> int:
        return sum(name.startswith(f"{BATCH}=") for name in folder_names(spark, f"{path}/{day}"))

    days = [name for name in folder_names(spark, path) if name.startswith(f"{PERIOD}=")]
    return sorted(date.fromisoformat(day.split("=", 1)[1]) for day in days if loads(day) > 1)


def read_merged(spark: SparkSession, path: str, keys: Sequence[str], order_by: Sequence[str],
                periods: Sequence[date] | None = None) -> DataFrame:
    """The newest row of each key, with the column ``period``; of the days ``periods`` only, if given.

    Only open days are shuffled. Filters on the period or the key reach the files of both kinds of days; one on
    another column is applied to the merged rows, as it has to be.
    """
    stored = read_table(spark, path)
    several = open_days(spark, path)
    if periods is not None:
        stored = stored.filter(F.col(PERIOD).isin(list(periods))) if periods else stored.filter(F.lit(False))
        several = [day for day in several if day in set(periods)]
    if not several:
        return stored.drop(BATCH)
    is_open = F.col(PERIOD).isin(several)
    newest = latest_per_key(stored.filter(is_open), [*keys, PERIOD], [*order_by, BATCH])
    return stored.filter(~is_open).unionByName(newest).drop(BATCH)


def merged_between(spark: SparkSession, path: str, keys: Sequence[str], order_by: Sequence[str], clock: str,
                   start: Column, end: Column | None = None) -> DataFrame:
    """Rows whose newest state has ``start <= clock <= end``; days that can hold none, by the index of ranges, stay closed.

    Days are taken whole, and the bounds hold for merged rows: an older state within them counts no more.
    """
    wanted = F.col(clock) >= start if end is None else F.col(clock).between(start, end)
    return read_merged(spark, path, keys, order_by, periods_between(spark, path, clock, start, end)).filter(wanted)


def compact_deltas(spark: SparkSession, path: str, before, keys: Sequence[str], order_by: Sequence[str]) -> int:
    """Merge the loads of the days before a date to one row a key, as :func:`read_merged` would; returns how many days.

    Loads that come meanwhile stay as deltas. A run that stops is completed by the next one.
    """
    return compact_days(spark, path, before, keys,
                        lambda rows: latest_per_key(rows, [*keys, PERIOD], [*order_by, BATCH]))


def changed_between(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Rows that the loads ``first`` to ``last`` brought and that are not yet compacted, with their number; for
    readers that follow a table. Reads the folders of these loads only."""
    if not table_exists(spark, path):
        raise ValueError(f"no table at {path}")
    return read_table(spark, path).filter(F.col(BATCH).between(first, last))

"""The newest reading of each region, kept as a small table of its own.

Each micro-batch brings its newest row of each region, and of stored and new rows the newest stays. The work follows
the rows of the batch and the number of regions, however long the history is; a batch that comes again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge.operators.keyed import latest_per_key
from skygauge.operators.serving import LATEST_COLUMNS, newest_of_regions
from skygauge.sources.snapshots import next_version, read_snapshot, write_snapshot

REGION, TIME = "governorate", "timestamp"


def _columns(rows: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in rows.columns]


def merge_latest(rows: DataFrame, path: str, version: int | None = None, columns: Sequence[str] = LATEST_COLUMNS) -> None:
    """Bring new readings into the view. Rows without region or time are no reading of a region.

    Of equal times the row with the greatest values stays, as in ``latest_weather``.
    """
    spark = rows.sparkSession
    version = next_version(spark, path) if version is None else version
    usable = F.col(REGION).isNotNull() & F.col(TIME).isNotNull()
    newest = latest_per_key(rows.filter(usable).select(*_columns(rows, columns)), [REGION], [TIME])
    stored = read_snapshot(spark, path, before=version)
    if stored is not None:
        newest = latest_per_key(stored.unionByName(newest, allowMissingColumns=True), [REGION], [TIME])
    write_snapshot(newest, path, version)


def rebuild_latest(readings: DataFrame, path: str, columns: Sequence[str] = LATEST_COLUMNS) -> None:
    """The view from all history, as after a restore of the reading table."""
    spark = readings.sparkSession
    newest = newest_of_regions(readings.filter(F.col(REGION).isNotNull()), TIME, _columns(readings, columns))
    write_snapshot(newest, path, next_version(spark, path))


def latest_view(spark: SparkSession, path: str) -> DataFrame:
    """One row per region. An error if nothing was ever merged."""
    view = read_snapshot(spark, path)
    if view is None:
        raise ValueError(f"no view of newest readings at {path}")
    return view

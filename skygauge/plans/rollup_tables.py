"""Stored rollups of the reading table and their refresh policies."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skygauge.functions.times import bucket
from skygauge.operators.pruning import PERIOD
from skygauge.operators.rollups import DAILY, HOURLY, in_buckets, refresh_range, weather_daily, weather_hourly
from skygauge.sources.tables import (BATCH, folder_names, path_exists, read_table, remove_path, replace_buckets,
                                     replace_range, table_exists, with_period)


class Policy(NamedTuple):
    rollup: Callable[[DataFrame], DataFrame]
    width: str
    start_offset: str
    end_offset: str


# --- fixed values: which buckets a scheduled refresh computes anew --------------------------
POLICIES = {
    "weather_hourly": Policy(weather_hourly, HOURLY, "3 HOURS", "1 HOUR"),
    "weather_daily": Policy(weather_daily, DAILY, "3 DAYS", "1 DAY"),
}


def refresh(readings: DataFrame, path: str, name: str, start: Column, end: Column) -> None:
    """Compute the buckets that start in [start, end) anew; only the days of the range are rewritten."""
    fresh = POLICIES[name].rollup(in_buckets(readings, start, end))
    replace_range(fresh, path, "bucket", start, end, ["bucket", "governorate"])


def scheduled_refresh(readings: DataFrame, path: str, name: str) -> None:
    """Refresh the range of the policy, counted back from the newest reading."""
    policy = POLICIES[name]
    refresh(readings, path, name, *refresh_range(readings, policy.width, policy.start_offset, policy.end_offset))


# --- buckets that late readings have changed -------------------------------------------------

def invalid_path(readings_path: str) -> str:
    return readings_path + "__invalid"


def note_invalid(rows: DataFrame, readings_path: str, batch_id: int) -> None:
    """Note the hours of late rows of a micro-batch; one row for each hour. A batch that comes again notes the same."""
    hours = rows.select(bucket("timestamp", HOURLY).alias("bucket")).distinct()
    hours.write.mode("overwrite").parquet(f"{invalid_path(readings_path)}/{BATCH}={batch_id}")


def _notes(spark: SparkSession, readings_path: str) -> list[str]:
    log = invalid_path(readings_path)
    if not path_exists(spark, log):
        return []
    return [f"{log}/{n}" for n in folder_names(spark, log) if table_exists(spark, f"{log}/{n}")]


def refresh_invalid(spark: SparkSession, readings_path: str, targets: dict[str, str],
                    readings: DataFrame | None = None) -> int:
    """Compute the buckets anew that late readings have hit, in each stored rollup; returns the number of hours.

    ``targets`` maps names of :data:`POLICIES` to paths. Only the days of noted hours are read, of readings and rollups
    alike, and only their buckets are computed. ``readings`` are the stored rows with their period, where the table
    isn't read as it is (``jobs.current_readings``). Notes that come meanwhile stay for the next call; if a run stops, its
    notes are taken again, which gives the same rows.
    """
    notes = _notes(spark, readings_path)
    if not notes:
        return 0
    hours = spark.read.parquet(*notes).select("bucket").distinct()
    days = [r[0] for r in with_period(hours, "bucket").select(PERIOD).distinct().collect()]  # bounded by the calendar
    readings = read_table(spark, readings_path) if readings is None else readings
    readings = readings.filter(F.col(PERIOD).isin(days))
    for name, path in targets.items():
        policy = POLICIES[name]
        buckets = hours.select(bucket("bucket", policy.width).alias("bucket")).distinct()
        hit = readings.withColumn("bucket", bucket("timestamp", policy.width)).join(buckets, "bucket", "left_semi").drop("bucket")
        replace_buckets(policy.rollup(hit), buckets, path, "bucket", ["bucket", "governorate"])
    count = hours.count()
    for note in notes:
        remove_path(spark, note)
    return count

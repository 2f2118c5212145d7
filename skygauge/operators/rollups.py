"""Time-bucket rollups, range refresh, retention and descriptive statistics of readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skygauge.functions.times import bucket, is_instant, utc_day, utc_instant
from skygauge.operators.pruning import between_times, from_time, newest_day

HOURLY, DAILY = "1 hour", "1 day"


def _rollup(readings: DataFrame, width: str, extra: list[Column]) -> DataFrame:
    # Partial aggregation on the map side: a hot region costs one row per task and bucket.
    return (readings
            .groupBy(F.window("timestamp", width).alias("bucket"), "governorate")
            .agg(F.count("*").alias("reading_count"),
                 F.avg("main_temp").alias("avg_temperature"),
                 F.min("main_temp_min").alias("min_temperature"),
                 F.max("main_temp_max").alias("max_temperature"),
                 F.avg("main_humidity").alias("avg_humidity"),
                 F.avg("wind_speed").alias("avg_wind_speed"),
                 F.avg("main_pressure").alias("avg_pressure"),
                 *extra)
            .withColumn("bucket", F.col("bucket.start")))


def weather_hourly(readings: DataFrame) -> DataFrame:
    return _rollup(readings, HOURLY, [F.avg("visibility").alias("avg_visibility")])


def weather_daily(readings: DataFrame) -> DataFrame:
    return _rollup(readings, DAILY, [F.max("clouds_all").alias("max_cloudiness")])


def minute_average(readings: DataFrame, metric: str, name: str) -> DataFrame:
    """One-minute average of a metric over all regions."""
    return (readings.groupBy(F.window("timestamp", "1 minute").alias("w"))
            .agg(F.avg(metric).alias(name))
            .select(F.col("w.start").alias("time"), name))


def in_buckets(readings: DataFrame, start: Column, end: Column) -> DataFrame:
    """Readings of the buckets that start in [start, end)."""
    return between_times(readings, "timestamp", start, end).filter(F.col("timestamp") < end)


def refresh_rollup(stored: DataFrame, readings: DataFrame, rollup, start: Column, end: Column) -> DataFrame:
    """``stored`` with the buckets that start in [start, end) computed anew from ``readings``.

    ``start`` and ``end`` must lie on bucket bounds. The range reaches the scan of the readings as
    a plain comparison, so only its files are read.
    """
    inside = (F.col("bucket") >= start) & (F.col("bucket") < end)
    fresh = rollup(in_buckets(readings, start, end))
    return stored.filter(~inside).unionByName(fresh)


def refresh_range(readings: DataFrame, width: str, start_offset: str, end_offset: str) -> tuple[Column, Column]:
    """Bucket-aligned refresh range [newest - start_offset, newest - end_offset)."""
    def edge(offset: str) -> Column:
        newest = newest_day(readings, "timestamp").agg((F.max("timestamp") - F.expr(f"INTERVAL {offset}")).alias("at"))
        return newest.select(bucket("at", width).alias("edge")).scalar()
    return edge(start_offset), edge(end_offset)


def retained(readings: DataFrame, as_of: Column | DataFrame, days: int, column: str = "timestamp") -> DataFrame:
    """Rows of the day chunks (UTC days of instants) that end after ``days`` before ``as_of``.

    ``as_of`` is a timestamp, or readings whose newest time counts.
    """
    instant = is_instant(readings, column)
    if isinstance(as_of, DataFrame):
        first_day = newest_day(as_of, column).agg(F.date_sub(utc_day(F.max(column), instant), days).alias("first_day")).scalar()
    else:
        first_day = F.date_sub(utc_day(as_of, instant), days)
    midnight = first_day.cast("timestamp_ntz")
    return from_time(readings, column, utc_instant(midnight) if instant else midnight)


def partition_stats(readings: DataFrame) -> DataFrame:
    return (readings.groupBy("kafka_partition")
            .agg(F.count("*").alias("total_records"),
                 F.countDistinct("governorate").alias("governorate_count"),
                 F.min("timestamp").alias("first_reading"),
                 F.max("timestamp").alias("last_reading"),
                 F.avg("main_temp").alias("avg_temperature"))
            .orderBy("kafka_partition"))


def governorate_temperature_stats(readings: DataFrame) -> DataFrame:
    return (readings.groupBy("governorate")
            .agg(F.count("*").alias("total_readings"),
                 F.avg("main_temp").alias("avg_temp"),
                 F.min("main_temp_min").alias("all_time_min"),
                 F.max("main_temp_max").alias("all_time_max"),
                 F.stddev_samp("main_temp").alias("temp_stddev"),
                 F.min("timestamp").alias("first_reading"),
                 F.max("timestamp").alias("last_reading"))
            .orderBy("governorate"))

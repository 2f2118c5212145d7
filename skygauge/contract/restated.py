"""Queries over a stored reading table whose rows are restated, and merged when they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge.contract import sqltext as S
from skygauge.contract.dashboards import DAILY_EXTRA, HOURLY_EXTRA, rollup_select, round_hourly, rounded
from skygauge.contract.registry import query
from skygauge.contract.standins import readings
from skygauge.functions.times import utc_instant, utc_wall_clock
from skygauge.plans.rollup_tables import POLICIES, refresh_invalid
from skygauge.session import scratch_path
from skygauge.sources.deltas import compact_deltas, merged_between
from skygauge.sources.tables import read_table, replace_range
from skygauge.streaming import jobs

_CLOCKS = ("timestamp", "recorded_at", "processed_at")
_COLUMNS = ("governorate", "kafka_partition", *_CLOCKS, "main_temp", "main_temp_min", "main_temp_max", "main_humidity",
            "main_pressure", "wind_speed", "visibility", "clouds_all")
#: Days before this one are compacted between the arrivals.
_CLOSED = "2024-01-12"

#: Every seventh reading is corrected an hour later.
_CORRECTED = """(SELECT * REPLACE (CASE WHEN id % 7 = 0 THEN main_temp + 1 ELSE main_temp END AS main_temp,
    CASE WHEN id % 7 = 0 THEN processed_at + INTERVAL 1 HOUR ELSE processed_at END AS processed_at) FROM readings)"""


def _arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Readings without the late ones; corrections; then late readings, corrected ones as they were before, and rows
    without region."""
    rows = readings(spark, sf_dir).select("id", *_COLUMNS).withColumns({c: utc_instant(c) for c in _CLOCKS})
    newest = rows.agg(F.max("timestamp").alias("newest")).scalar()
    late = (F.col("id") % 5 == 0) & (F.col("timestamp") < newest - F.expr("INTERVAL 15 HOURS"))
    wrong = F.col("id") % 7 == 0
    corrected = rows.filter(wrong).withColumns({
        "main_temp": F.col("main_temp") + 1, "processed_at": F.col("processed_at") + F.expr("INTERVAL 1 HOUR")})
    lost = rows.filter(F.col("id") % 11 == 0).withColumn("governorate", F.lit(None).cast("string"))
    parts = [rows.filter(~late), corrected, rows.filter(late | wrong).unionByName(lost)]
    return [part.drop("id") for part in parts]


def _arrive(spark: SparkSession, place: str, rows: DataFrame) -> None:
    """Land the rows and run the stream over them to its end. No delay, so that all changed hours are noted."""
    rows.write.mode("append").parquet(f"{place}/in")
    stream = jobs.read_files(spark, f"{place}/in", rows.schema)
    jobs.merge_readings(stream, f"{place}/table", f"{place}/checkpoint", interval=None, quarantine=f"{place}/aside",
                        delay="0 hours").awaitTermination()


def _compact(spark: SparkSession, place: str) -> None:
    compact_deltas(spark, f"{place}/table", _CLOSED, jobs.READING_KEY, jobs.READING_ORDER)


def _table(spark: SparkSession, sf_dir: str) -> str:
    place = scratch_path(spark, "restated")
    first, corrected, late = _arrivals(spark, sf_dir)
    _arrive(spark, place, first)
    _arrive(spark, place, corrected)
    _compact(spark, place)
    _arrive(spark, place, late)
    return place


@query(S.with_readings(f"""SELECT 'table' AS place, governorate, "timestamp", processed_at, main_temp, wind_speed FROM {_CORRECTED}
    UNION ALL SELECT 'aside', NULL, "timestamp", processed_at, main_temp, wind_speed FROM readings WHERE id % 11 = 0"""))
def stream_restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading as it was stated last, from deltas of which some days are compacted; those without region aside."""
    place = _table(spark, sf_dir)
    columns = ["governorate", "timestamp", "processed_at", "main_temp", "wind_speed"]
    kept = jobs.current_readings(spark, f"{place}/table").select(F.lit("table").alias("place"), *columns)
    aside = spark.read.parquet(f"{place}/aside").select(F.lit("aside").alias("place"), *columns)
    return kept.unionByName(aside).withColumns({c: utc_wall_clock(c) for c in ("timestamp", "processed_at")})


_START, _END = "2024-01-11 06:00:00", "2024-01-13 18:00:00"


@query(S.with_readings(f"""SELECT kafka_partition, count(*) AS records, min(processed_at) AS first, max(processed_at) AS last,
    max(main_temp) AS highest FROM {_CORRECTED}
    WHERE processed_at BETWEEN TIMESTAMP '{_START}' AND TIMESTAMP '{_END}' GROUP BY 1"""))
def arrivals_restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that were last stated within a span of processing times; the index names the days to open."""
    start, end = (utc_instant(F.lit(t).cast("timestamp_ntz")) for t in (_START, _END))
    rows = merged_between(spark, f"{_table(spark, sf_dir)}/table", jobs.READING_KEY, jobs.READING_ORDER, "processed_at", start, end)
    return rows.groupBy("kafka_partition").agg(
        F.count("*").alias("records"), utc_wall_clock(F.min("processed_at")).alias("first"),
        utc_wall_clock(F.max("processed_at")).alias("last"), F.max("main_temp").alias("highest"))


@query(S.with_readings(f"""SELECT 'hour' AS width, bucket, governorate, reading_count, avg_temperature, min_temperature,
    max_temperature FROM ({rollup_select('hour', HOURLY_EXTRA)})
    UNION ALL SELECT 'day', bucket, governorate, reading_count, avg_temperature, min_temperature, max_temperature
    FROM ({rollup_select('day', DAILY_EXTRA)})""".replace("FROM readings", f"FROM {_CORRECTED}")))
def rollup_restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rollups, built before anything was restated, after the buckets of restated and late readings were computed anew."""
    place = scratch_path(spark, "restated-rollup")
    first, corrected, late = _arrivals(spark, sf_dir)
    _arrive(spark, place, first)
    targets = {name: f"{place}/{name}" for name in POLICIES}
    start, end = F.lit("2000-01-01").cast("timestamp"), F.lit("2100-01-01").cast("timestamp")
    stored = jobs.current_readings(spark, f"{place}/table")
    for name, path in targets.items():
        replace_range(POLICIES[name].rollup(stored), path, "bucket", start, end, ["bucket", "governorate"])
    _arrive(spark, place, corrected)
    _compact(spark, place)
    _arrive(spark, place, late)
    refresh_invalid(spark, f"{place}/table", targets, jobs.current_readings(spark, f"{place}/table"))
    columns = ["bucket", "governorate", "reading_count", "avg_temperature", "min_temperature", "max_temperature"]
    hourly = round_hourly(read_table(spark, targets["weather_hourly"])).select(F.lit("hour").alias("width"), *columns)
    daily = rounded(read_table(spark, targets["weather_daily"]), 9, "avg_temperature").select(F.lit("day").alias("width"), *columns)
    return hourly.unionByName(daily).withColumn("bucket", utc_wall_clock("bucket"))

"""Queries over a stored reading table that gets late, repeated and unusable readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge.contract import sqltext as S
from skygauge.contract.dashboards import DAILY_EXTRA, HOURLY_EXTRA, rollup_select, round_hourly, rounded
from skygauge.contract.registry import query
from skygauge.contract.standins import readings
from skygauge.functions.times import utc_instant, utc_wall_clock
from skygauge.operators import serving
from skygauge.operators.pruning import newest_day
from skygauge.plans.latest_view import latest_view
from skygauge.plans import health, stat_states
from skygauge.plans.rollup_tables import POLICIES, refresh_invalid
from skygauge.session import scratch_path
from skygauge.sources.ranges import newest_value, read_between
from skygauge.sources.tables import read_table, replace_range
from skygauge.streaming import jobs

_CLOCKS = ("timestamp", "recorded_at", "processed_at")
_COLUMNS = tuple(dict.fromkeys((*serving.LATEST_COLUMNS, "processed_at", "kafka_partition", "main_temp_min", "main_temp_max",
                                "main_pressure")))


def _arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All readings in three arrivals. The second repeats old ones of the first; the last is ten hours late and more, holds
    repeats of itself and of the others, and rows without region or time."""
    rows = readings(spark, sf_dir).select("id", *_COLUMNS).withColumns({c: utc_instant(c) for c in _CLOCKS})
    newest = rows.agg(F.max("timestamp").alias("newest")).scalar()
    late = (F.col("id") % 5 == 0) & (F.col("timestamp") < newest - F.expr("INTERVAL 15 HOURS"))
    last = F.col("timestamp") > newest - F.expr("INTERVAL 5 HOURS")
    lost = rows.filter(F.col("id") % 11 == 0)
    parts = [[rows.filter(~late & ~last)],
             [rows.filter(~late & last), rows.filter(~late & ~last & (F.col("id") % 7 == 0))],
             [rows.filter(late), rows.filter(late), rows.filter(~late & (F.col("id") % 3 == 0)),
              lost.withColumn("governorate", F.lit(None).cast("string")),
              lost.withColumn("timestamp", F.lit(None).cast("timestamp"))]]
    out = []
    for some in parts:
        both = some[0]
        for other in some[1:]:
            both = both.unionByName(other)
        out.append(both.drop("id"))
    return out


def _arrive(spark: SparkSession, place: str, rows: DataFrame, *views: str) -> None:
    """Land the rows and run the stream over them to its end, with the named views (``latest``, ``states``)."""
    rows.write.mode("append").parquet(f"{place}/in")
    stream = jobs.read_files(spark, f"{place}/in", rows.schema)
    jobs.append_readings(stream, f"{place}/table", f"{place}/checkpoint", interval=None, quarantine=f"{place}/aside",
                         **{v: f"{place}/{v}" for v in views}).awaitTermination()


def _stored_at_once(spark: SparkSession, sf_dir: str) -> str:
    place = scratch_path(spark, "stored")
    rows = readings(spark, sf_dir).select(*_COLUMNS)
    _arrive(spark, place, rows.withColumns({c: utc_instant(c) for c in _CLOCKS}))
    return f"{place}/table"


def _late_table(spark: SparkSession, sf_dir: str, *views: str) -> str:
    place = scratch_path(spark, "late")
    for rows in _arrivals(spark, sf_dir):
        _arrive(spark, place, rows, *views)
    return place


@query(S.with_readings("""SELECT 'table' AS place, governorate, "timestamp", main_temp, wind_speed FROM readings
    UNION ALL SELECT 'aside', NULL, "timestamp", main_temp, wind_speed FROM readings WHERE id % 11 = 0
    UNION ALL SELECT 'aside', governorate, NULL, main_temp, wind_speed FROM readings WHERE id % 11 = 0"""))
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading once, however late and often it came; those without key aside."""
    place = _late_table(spark, sf_dir)
    columns = ["governorate", utc_wall_clock("timestamp").alias("timestamp"), "main_temp", "wind_speed"]
    kept = read_table(spark, f"{place}/table").select(F.lit("table").alias("place"), *columns)
    aside = spark.read.parquet(f"{place}/aside").select(F.lit("aside").alias("place"), *columns)
    return kept.unionByName(aside)


@query(S.with_readings(f"""SELECT {', '.join(f'"{c}"' for c in serving.LATEST_COLUMNS)} FROM readings
    WHERE governorate IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY governorate ORDER BY "timestamp" DESC) = 1"""))
def latest_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest reading of each region from the view that the stream keeps along; no reading is scanned for it."""
    view = latest_view(spark, f"{_late_table(spark, sf_dir, 'latest')}/latest")
    return view.select(*serving.LATEST_COLUMNS).withColumns({c: utc_wall_clock(c) for c in ("timestamp", "recorded_at")})


_START, _END = "2024-01-05 06:00:00", "2024-01-06 18:00:00"


@query(S.with_readings(f"""SELECT recorded_at AS time, governorate AS metric, main_temp AS value FROM readings
    WHERE recorded_at BETWEEN TIMESTAMP '{_START}' AND TIMESTAMP '{_END}'"""))
def panel_stored_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature series of a stored table by recording time: the index names the days to open."""
    path = _stored_at_once(spark, sf_dir)
    start, end = (utc_instant(F.lit(t).cast("timestamp_ntz")) for t in (_START, _END))
    rows = read_between(spark, path, "recorded_at", start, end)
    return serving.temperature_series(rows).withColumn("time", utc_wall_clock("time"))


@query(S.with_readings("""SELECT kafka_partition, count(*) AS records, max(processed_at) AS latest FROM readings
    WHERE processed_at >= (SELECT max(processed_at) FROM readings) - INTERVAL 30 MINUTE GROUP BY 1"""))
def arrivals_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings processed in the last half hour of a stored table; newest time and days come from the index."""
    path = _stored_at_once(spark, sf_dir)
    bound = spark.range(1).select(newest_value(spark, path, "processed_at") - F.expr("INTERVAL 30 MINUTES")).first()[0]
    rows = read_between(spark, path, "processed_at", F.lit(bound))
    return rows.groupBy("kafka_partition").agg(F.count("*").alias("records"), utc_wall_clock(F.max("processed_at")).alias("latest"))


@query(S.with_readings(f"""SELECT 'hour' AS width, bucket, governorate, reading_count, avg_temperature, min_temperature,
    max_temperature FROM ({rollup_select('hour', HOURLY_EXTRA)})
    UNION ALL SELECT 'day', bucket, governorate, reading_count, avg_temperature, min_temperature, max_temperature
    FROM ({rollup_select('day', DAILY_EXTRA)})"""))
def rollup_invalidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rollups, built before the late readings came, after the buckets that those hit were computed anew."""
    place = scratch_path(spark, "invalid")
    *before, late = _arrivals(spark, sf_dir)
    for rows in before:
        _arrive(spark, place, rows)
    stored = read_table(spark, f"{place}/table")
    targets = {name: f"{place}/{name}" for name in POLICIES}
    start, end = F.lit("2000-01-01").cast("timestamp"), F.lit("2100-01-01").cast("timestamp")
    for name, path in targets.items():
        replace_range(POLICIES[name].rollup(stored), path, "bucket", start, end, ["bucket", "governorate"])
    _arrive(spark, place, late)
    refresh_invalid(spark, f"{place}/table", targets)
    columns = ["bucket", "governorate", "reading_count", "avg_temperature", "min_temperature", "max_temperature"]
    hourly = round_hourly(read_table(spark, targets["weather_hourly"])).select(F.lit("hour").alias("width"), *columns)
    daily = rounded(read_table(spark, targets["weather_daily"]), 9, "avg_temperature").select(F.lit("day").alias("width"), *columns)
    return hourly.unionByName(daily).withColumn("bucket", utc_wall_clock("bucket"))


@query(S.with_readings("""SELECT 'region' AS kind, governorate AS name, count(*) AS readings, round(avg(main_temp), 9) AS mean,
    round(stddev_samp(main_temp), 8) AS deviation, min(main_temp_min) AS low, max(main_temp_max) AS high, CAST(1 AS BIGINT) AS regions,
    min("timestamp") AS first, max("timestamp") AS last FROM readings GROUP BY governorate
    UNION ALL SELECT 'partition', CAST(kafka_partition AS VARCHAR), count(*), round(avg(main_temp), 9), NULL, NULL, NULL,
        count(DISTINCT governorate), min("timestamp"), max("timestamp") FROM readings GROUP BY kafka_partition
    UNION ALL SELECT 'all', NULL, count(*), NULL, NULL, NULL, NULL, count(DISTINCT governorate), min("timestamp"),
        max("timestamp") FROM readings"""))
def stats_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of regions, of partitions and of all, merged from the states that the stream has stored."""
    path = f"{_late_table(spark, sf_dir, 'states')}/states"
    none = F.lit(None).cast("double")
    regions = stat_states.region_statistics(spark, path).select(
        F.lit("region").alias("kind"), F.col("governorate").alias("name"), F.col("total_readings").alias("readings"),
        F.col("avg_temp").alias("mean"), F.round("temp_stddev", 8).alias("deviation"), F.col("all_time_min").alias("low"),
        F.col("all_time_max").alias("high"), F.lit(1).cast("long").alias("regions"), F.col("first_reading").alias("first"),
        F.col("last_reading").alias("last"))
    partitions = stat_states.partition_statistics(spark, path).select(
        F.lit("partition"), F.col("kafka_partition").cast("string"), "total_records", "avg_temperature", none, none, none,
        "governorate_count", "first_reading", "last_reading")
    everything = stat_states.reading_metrics(spark, path).select(
        F.lit("all"), F.lit(None).cast("string"), "total_records", none, none, none, none, "unique_governorates", "first_record",
        "last_record")
    rows = regions.union(partitions).union(everything)
    return rounded(rows, 9, "mean").withColumns({c: utc_wall_clock(c) for c in ("first", "last")})


@query(S.with_readings("""SELECT 'readings' AS name, true AS present, count(*) AS records, max("timestamp") AS latest FROM readings
    WHERE "timestamp" > (SELECT max("timestamp") FROM readings) - INTERVAL 1 HOUR
    UNION ALL SELECT 'missing', false, NULL, NULL"""))
def table_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a reading table is there, and what its last hour holds."""
    path = _stored_at_once(spark, sf_dir)
    newest = newest_day(read_table(spark, path), "timestamp").agg(F.max("timestamp")).first()[0]
    found = []
    for name, place in (("readings", path), ("missing", f"{path}-missing")):
        try:
            checked = health.check_table(spark, place, F.lit(newest))
            found.append(checked.select(F.lit(name).alias("name"), F.lit(True).alias("present"), "records",
                                        utc_wall_clock("latest").alias("latest")))
        except ValueError:
            found.append(spark.range(1).select(F.lit(name).alias("name"), F.lit(False).alias("present"),
                                               F.lit(None).cast("long").alias("records"),
                                               F.lit(None).cast("timestamp_ntz").alias("latest")))
    return found[0].unionByName(found[1])

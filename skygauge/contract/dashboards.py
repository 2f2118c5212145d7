"""Queries over sensor readings: rollups, views, dashboard panels and recent-data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge import lookups as L
from skygauge.contract import sqltext as S
from skygauge.contract.registry import query
from skygauge.contract.standins import load, readings
from skygauge.functions.units import kelvin_to_celsius
from skygauge.operators import quality, rollups, serving
from skygauge.operators.places import partition_info as describe_partitions, with_partition


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- rollups ---------------------------------------------------------------------------------

_AVERAGES = ("avg_temperature", "avg_humidity", "avg_wind_speed", "avg_pressure")


def rollup_select(unit: str, extra: str, source: str = "readings", where: str = "") -> str:
    return f"""SELECT date_trunc('{unit}', "timestamp") AS bucket, governorate, count(*) AS reading_count,
        round(avg(main_temp), 9) AS avg_temperature, min(main_temp_min) AS min_temperature,
        max(main_temp_max) AS max_temperature, round(avg(main_humidity), 9) AS avg_humidity,
        round(avg(wind_speed), 9) AS avg_wind_speed, round(avg(main_pressure), 9) AS avg_pressure, {extra}
        FROM {source} {where} GROUP BY 1, 2"""


HOURLY_EXTRA = "round(avg(visibility), 9) AS avg_visibility"
DAILY_EXTRA = "max(clouds_all) AS max_cloudiness"


def round_hourly(df: DataFrame) -> DataFrame:
    return rounded(df, 9, *_AVERAGES, "avg_visibility")


@query(S.with_readings(rollup_select("hour", HOURLY_EXTRA)))
def rollup_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_hourly(rollups.weather_hourly(readings(spark, sf_dir)))


@query(S.with_readings(rollup_select("day", DAILY_EXTRA)))
def rollup_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.weather_daily(readings(spark, sf_dir)), 9, *_AVERAGES)


@query(S.with_readings("""SELECT date_trunc('minute', "timestamp") AS time, round(avg(main_temp), 9) AS temperature
    FROM readings GROUP BY 1"""))
def minute_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.minute_average(readings(spark, sf_dir), "main_temp", "temperature"), 9, "temperature")


@query(S.with_readings("""SELECT date_trunc('minute', "timestamp") AS time, round(avg(main_humidity), 9) AS humidity
    FROM readings GROUP BY 1"""))
def minute_humidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.minute_average(readings(spark, sf_dir), "main_humidity", "humidity"), 9, "humidity")


_LATE = "weather_main = 'Thunderstorm'"


@query(f"""WITH {S.READINGS},
    bounds AS (SELECT date_trunc('hour', max("timestamp") - INTERVAL 3 HOUR) AS lo,
                      date_trunc('hour', max("timestamp") - INTERVAL 1 HOUR) AS hi FROM readings),
    old AS ({rollup_select('hour', HOURLY_EXTRA, where='WHERE NOT ' + _LATE)}),
    fresh AS ({rollup_select('hour', HOURLY_EXTRA)})
    SELECT old.* FROM old, bounds WHERE bucket < lo OR bucket >= hi
    UNION ALL SELECT fresh.* FROM fresh, bounds WHERE bucket >= lo AND bucket < hi""")
def rollup_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly rollup built before the storms arrived, its last hours then computed anew."""
    rows = readings(spark, sf_dir)
    stored = rollups.weather_hourly(rows.filter(f"NOT ({_LATE})"))
    start, end = rollups.refresh_range(rows, rollups.HOURLY, "3 HOURS", "1 HOUR")
    return round_hourly(rollups.refresh_rollup(stored, rows, rollups.weather_hourly, start, end))


@query(S.with_readings("""SELECT * FROM readings WHERE "timestamp" >=
    (SELECT CAST(max("timestamp") AS DATE) - INTERVAL 10 DAY FROM readings)"""))
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir)
    return rollups.retained(rows, rows, days=10)


@query(S.with_readings("""SELECT kafka_partition, count(*) AS total_records,
    count(DISTINCT governorate) AS governorate_count, min("timestamp") AS first_reading,
    max("timestamp") AS last_reading, round(avg(main_temp), 9) AS avg_temperature
    FROM readings GROUP BY 1"""))
def partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.partition_stats(readings(spark, sf_dir)), 9, "avg_temperature")


@query(S.with_readings("""SELECT governorate, count(*) AS total_readings, round(avg(main_temp), 9) AS avg_temp,
    min(main_temp_min) AS all_time_min, max(main_temp_max) AS all_time_max,
    round(stddev_samp(main_temp), 8) AS temp_stddev, min("timestamp") AS first_reading,
    max("timestamp") AS last_reading FROM readings GROUP BY 1"""))
def region_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rollups.governorate_temperature_stats(readings(spark, sf_dir))
    return rounded(rounded(stats, 9, "avg_temp"), 8, "temp_stddev")


# --- latest ----------------------------------------------------------------------------------

@query(S.with_readings(f"""SELECT {', '.join(f'"{c}"' for c in serving.LATEST_COLUMNS)} FROM (
    SELECT *, row_number() OVER (PARTITION BY governorate ORDER BY "timestamp" DESC) AS rn FROM readings)
    WHERE rn = 1"""))
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_weather(readings(spark, sf_dir))


@query(S.with_readings("""SELECT governorate, coord_lat AS latitude, coord_lon AS longitude,
    main_temp AS temperature, weather_main, weather_description FROM readings
    WHERE id IN (SELECT max(id) FROM readings GROUP BY governorate)"""))
def latest_by_max_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_by_max_id(readings(spark, sf_dir))


_START, _END = "2024-01-05 00:00:00", "2024-01-25 00:00:00"
_REGIONS = "Cairo|Port .*|.*Sinai"
_IN_RANGE = f"recorded_at BETWEEN TIMESTAMP '{_START}' AND TIMESTAMP '{_END}'"
_IN_REGIONS = f"regexp_full_match(governorate, '{_REGIONS}')"


def _panel(spark: SparkSession, sf_dir: str, pattern: str = _REGIONS) -> DataFrame:
    """Readings a dashboard panel sees: its time range and its region choice."""
    start, end = (F.lit(t).cast("timestamp_ntz") for t in (_START, _END))
    return serving.match_region(serving.in_range(readings(spark, sf_dir), start, end), pattern)


@query(S.with_readings("SELECT " + ", ".join(
    f"(SELECT {m} FROM readings WHERE {_IN_RANGE} AND {_IN_REGIONS} ORDER BY recorded_at DESC LIMIT 1) AS {m}"
    for m in serving.NEWEST_METRICS)))
def dash_latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.newest_values(_panel(spark, sf_dir))


@query(S.with_readings(f"""SELECT governorate AS "Governorate", round(main_temp, 1) AS "Temperature (°C)",
    main_humidity AS "Humidity (%)", round(wind_speed, 2) AS "Wind Speed (m/s)",
    main_pressure AS "Pressure (hPa)", weather_main AS "Condition", recorded_at AS "Last Update"
    FROM (SELECT *, row_number() OVER (PARTITION BY governorate ORDER BY recorded_at DESC) AS rn
          FROM readings WHERE {_IN_RANGE}) WHERE rn = 1"""))
def dash_statistics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.statistics_table(_panel(spark, sf_dir, ".*"))


_ALERT = ("(main_temp > 40 OR main_temp < 5 OR wind_speed > 15 "
          "OR weather_main IN ('Rain', 'Thunderstorm', 'Snow'))")


@query(S.with_readings(f"""SELECT governorate AS "Location", main_temp AS "Temp (°C)", wind_speed AS "Wind (m/s)",
    weather_main AS "Condition", recorded_at AS "Time" FROM readings WHERE {_IN_RANGE} AND {_ALERT}
    ORDER BY recorded_at DESC LIMIT 50"""))
def dash_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.alerts(_panel(spark, sf_dir, ".*"))


@query(S.with_readings(f"""SELECT recorded_at AS time, governorate AS metric, main_temp AS value
    FROM readings WHERE {_IN_RANGE} AND {_IN_REGIONS}"""))
def dash_temperature_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.temperature_series(_panel(spark, sf_dir))


@query(S.with_readings("SELECT weather_main, count(*) AS count FROM readings GROUP BY 1"))
def condition_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.condition_distribution(readings(spark, sf_dir))


@query(S.with_readings("SELECT kafka_partition AS metric, count(*) AS value FROM readings GROUP BY 1"))
def dash_message_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.message_count(readings(spark, sf_dir))


@query(S.with_readings("""SELECT date_trunc('minute', processed_at) AS time, kafka_partition AS metric,
    count(*) AS value FROM readings WHERE kafka_partition IN (0, 2) GROUP BY 1, 2"""))
def dash_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.throughput(readings(spark, sf_dir), "0,2")


@query(S.with_readings("SELECT recorded_at AS time, governorate, epoch(processed_at - recorded_at) AS latency FROM readings"))
def dash_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latency(readings(spark, sf_dir))


@query(S.with_readings(f"SELECT weather_main, count(*) AS count FROM readings WHERE {_IN_RANGE} AND {_IN_REGIONS} GROUP BY 1"))
def panel_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions in the panel's time range and regions."""
    return serving.condition_distribution(_panel(spark, sf_dir))


@query(S.with_readings(f"""SELECT kafka_partition AS metric, count(*) AS value FROM readings
    WHERE {_IN_RANGE} AND {_IN_REGIONS} GROUP BY 1"""))
def panel_message_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.message_count(_panel(spark, sf_dir))


@query(S.with_readings(f"""SELECT recorded_at AS time, governorate, epoch(processed_at - recorded_at) AS latency
    FROM readings WHERE {_IN_RANGE} AND {_IN_REGIONS}"""))
def panel_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latency(_panel(spark, sf_dir))


@query(S.with_readings(f"""SELECT date_trunc('minute', processed_at) AS time, kafka_partition AS metric, count(*) AS value
    FROM readings WHERE kafka_partition IN (0, 2) AND {_IN_RANGE.replace('recorded_at', 'processed_at')} GROUP BY 1, 2"""))
def panel_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages a minute in a range of their processing time."""
    start, end = (F.lit(t).cast("timestamp_ntz") for t in (_START, _END))
    return serving.throughput(serving.in_range(readings(spark, sf_dir), start, end, "processed_at"), "0,2")


@query(S.with_readings("""SELECT "timestamp", id, main_pressure FROM readings ORDER BY "timestamp" DESC, id LIMIT 50"""))
def newest_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pressure of the 50 newest readings; the order makes the panel's limit repeatable."""
    newest = serving.newest_rows(readings(spark, sf_dir), "timestamp", 50, ["id"])
    return newest.select("timestamp", "id", "main_pressure")


_SHOWN = {"main_temp": "Temperature", "main_humidity": "Humidity"}
_LONG = " UNION ALL ".join(
    f"SELECT recorded_at AS time, '{shown}' AS metric, CAST({c} AS DOUBLE) AS value FROM readings "
    f"WHERE {_IN_RANGE} AND {_IN_REGIONS}" for c, shown in _SHOWN.items())


@query(S.with_readings(_LONG))
def metric_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.metrics_long(_panel(spark, sf_dir), _SHOWN)


@query(S.with_readings("SELECT metric, governorate, max(last) AS last_not_null, round(avg(value), 9) AS mean, "
                       "max(value) AS max, min(value) AS min, round(sum(value), 4) AS sum FROM (SELECT *, "
                       "first_value(value) OVER (PARTITION BY metric, governorate ORDER BY value IS NULL, time DESC) AS last FROM ("
                       + " UNION ALL ".join(
                           f"SELECT recorded_at AS time, governorate, '{shown}' AS metric, CAST({c} AS DOUBLE) AS value "
                           "FROM readings" for c, shown in _SHOWN.items()) + ")) GROUP BY ALL"))
def series_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = serving.metrics_long(readings(spark, sf_dir), _SHOWN, keys=["governorate"])
    return rounded(rounded(serving.reduce_series(series, ["metric", "governorate"]), 9, "mean"), 4, "sum")


_SUMMARY = {"main_temp": "Temperature", "main_humidity": "Humidity", "main_pressure": "Pressure",
            "wind_speed": "Wind Speed"}


@query(S.with_readings('SELECT governorate, ' + ", ".join(
    f'max(CASE WHEN rn_{c} = 1 THEN CAST({c} AS DOUBLE) END) AS "{shown}"' for c, shown in _SUMMARY.items())
    + " FROM (SELECT *, " + ", ".join(
        f"row_number() OVER (PARTITION BY governorate ORDER BY {c} IS NULL, recorded_at DESC) AS rn_{c}"
        for c in _SUMMARY) + " FROM readings) GROUP BY 1"))
def metric_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last known value of four metric series, merged to one row per region."""
    series = serving.metrics_long(readings(spark, sf_dir), _SUMMARY, keys=["governorate"])
    last = (serving.reduce_series(series, ["governorate", "metric"])
            .select("governorate", "metric", F.col("last_not_null").alias("value")))
    return serving.metrics_wide(last, list(_SUMMARY.values()))


@query(S.with_readings(""" SELECT 'governorate' AS choice, governorate AS value FROM readings GROUP BY 2
    UNION ALL SELECT 'partition', CAST(kafka_partition AS VARCHAR) FROM readings WHERE governorate = 'Cairo' GROUP BY 2"""))
def dash_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values the dashboard offers for region and partition."""
    rows = readings(spark, sf_dir)
    regions = serving.choices(rows, "governorate").select(F.lit("governorate").alias("choice"), F.col("governorate").alias("value"))
    numbers = serving.choices(serving.match_region(rows, "Cairo"), "kafka_partition")
    return regions.unionByName(numbers.select(
        F.lit("partition").alias("choice"), F.col("kafka_partition").cast("string").alias("value")))


@query(S.with_readings("""SELECT governorate, round(main_temp, 2) AS temp_celsius, weather_main, "timestamp"
    FROM readings ORDER BY "timestamp" DESC, id LIMIT 10"""))
def newest_celsius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten newest readings, their Kelvin temperatures in Celsius."""
    kelvin = readings(spark, sf_dir).withColumn("main_temp", F.col("main_temp") + L.KELVIN_OFFSET)
    newest = serving.newest_rows(kelvin, "timestamp", 10, ["id"])
    return newest.select("governorate", kelvin_to_celsius("main_temp").alias("temp_celsius"), "weather_main", "timestamp")


@query(S.with_readings(f"""SELECT * FROM ({rollup_select('hour', HOURLY_EXTRA)}) WHERE governorate = 'Cairo'
    ORDER BY bucket DESC LIMIT 24"""))
def newest_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 24 hours of one region."""
    hours = rollups.weather_hourly(readings(spark, sf_dir)).filter("governorate = 'Cairo'")
    return round_hourly(serving.newest_rows(hours, "bucket", 24, ["governorate"]))


# --- recent data -----------------------------------------------------------------------------

def _since_sql(interval: str) -> str:
    return f'"timestamp" > (SELECT max("timestamp") - INTERVAL {interval} FROM readings)'


@query(S.with_readings(f"""SELECT governorate, main_temp, main_humidity, main_pressure, wind_speed, weather_main,
    "timestamp" FROM readings WHERE {_since_sql('30 MINUTE')}"""))
def recent_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir)
    return serving.since(rows, rows, "30 MINUTES").select(
        "governorate", "main_temp", "main_humidity", "main_pressure", "wind_speed", "weather_main", "timestamp")


@query(S.with_readings(f'SELECT "timestamp" AS time, wind_speed FROM readings WHERE {_since_sql("1 HOUR")}'))
def recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir)
    return serving.since(rows, rows, "1 HOUR").select(F.col("timestamp").alias("time"), "wind_speed")


@query(S.with_readings(f"""SELECT kafka_partition, count(*) AS records, max("timestamp") AS latest
    FROM readings WHERE {_since_sql('1 HOUR')} GROUP BY 1"""))
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir)
    return quality.freshness(serving.since(rows, rows, "1 HOUR"), ["kafka_partition"])


@query(S.with_readings(f"""SELECT gov_count, total_records, round(avg_temp, 9) AS avg_temp, min_temp, max_temp,
    concat_ws('; ', CASE WHEN gov_count < 20 THEN 'Low governorate coverage: ' || gov_count || '/27' END,
        CASE WHEN total_records < 100 THEN 'Low record count: ' || total_records END,
        CASE WHEN avg_temp < -10 OR avg_temp > 60 THEN 'Suspicious avg_temp: ' || avg_temp END) AS issues
    FROM (SELECT count(DISTINCT governorate) AS gov_count, count(*) AS total_records, avg(main_temp) AS avg_temp,
                 min(main_temp) AS min_temp, max(main_temp) AS max_temp FROM readings
          WHERE {_since_sql('6 HOUR')})"""))
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir)
    summary = quality.quality_summary(serving.since(rows, rows, "6 HOURS"))
    return rounded(summary, 9, "avg_temp").withColumn("issues", F.array_join("issues", "; "))


@query(S.with_readings("""SELECT count(*) AS total_records, count(DISTINCT governorate) AS unique_governorates,
    min("timestamp") AS first_record, max("timestamp") AS last_record FROM readings"""))
def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ingest_metrics(readings(spark, sf_dir))


_COUNTED = ("orders", "lineitem", "events", "customer")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED))
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.table_counts({t: load(spark, sf_dir, t) for t in _COUNTED})


_DATED = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(max({c}) AS DATE) AS newest FROM {t}"
                          for t, c in _DATED.items()))
def layer_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.newest_per_table({t: (load(spark, sf_dir, t), c) for t, c in _DATED.items()})


@query("""SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS row_count FROM lineitem
    WHERE year(l_shipdate) = 1997 GROUP BY 1 ORDER BY 1 DESC LIMIT 10""")
def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.daily_counts(load(spark, sf_dir, "lineitem"), "l_shipdate", 1997)


# --- stream partitions -----------------------------------------------------------------------

@query(S.with_readings("""SELECT governorate, kafka_partition, count(*) AS n FROM readings GROUP BY ALL"""))
def partition_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per region with the partition looked up; unknown regions have none."""
    rows = with_partition(readings(spark, sf_dir).drop("kafka_partition"))
    return rows.groupBy("governorate", "kafka_partition").agg(F.count("*").alias("n"))


_MEMBERS = ", ".join(f"({n}, {S.text(L.STREAM_PARTITION_NAMES[n][0])}, {S.text(L.STREAM_PARTITION_NAMES[n][1])}, "
                     f"{S.text(g)})" for n, names in L.STREAM_PARTITIONS.items() for g in names)


@query(S.with_readings(f"""SELECT partition, partition_name, description,
    array_to_string(list_sort(list(m.governorate)), ',') AS governorates, count(*) AS governorate_count,
    CAST(coalesce(sum(n), 0) AS BIGINT) AS readings
    FROM (VALUES {_MEMBERS}) m(partition, partition_name, description, governorate)
    LEFT JOIN (SELECT governorate, count(*) AS n FROM readings GROUP BY 1) r ON m.governorate = r.governorate
    GROUP BY 1, 2, 3"""))
def partition_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_partitions(spark, readings(spark, sf_dir)).withColumn(
        "governorates", F.array_join("governorates", ","))

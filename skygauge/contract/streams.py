"""Queries of the streaming half: messages as a batch, and file streams run to their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge.contract import sqltext as S
from skygauge.contract.dashboards import HOURLY_EXTRA, DAILY_EXTRA, rollup_select, round_hourly, rounded
from skygauge.contract.registry import query
from skygauge.contract.standins import load, readings, readings_from
from skygauge.functions.times import utc_instant, utc_wall_clock
from skygauge.session import scratch_path
from skygauge.sources.tables import BATCH, read_table
from skygauge.streaming import jobs
from skygauge.streaming.messages import (accepted, deliverable, envelopes, flat_readings, flatten_answers, parse,
                                         rejected, unknown_region)


def _answers(rows: DataFrame) -> DataFrame:
    """Readings as nested JSON answers of the weather API."""
    second = F.unix_seconds(utc_instant("timestamp"))
    day = second - F.pmod(second, F.lit(86400))
    answer = F.struct(
        F.struct(F.col("coord_lon").alias("lon"), F.col("coord_lat").alias("lat")).alias("coord"),
        F.array(F.struct(F.col("main_humidity").alias("id"), F.col("weather_main").alias("main"),
                         F.col("weather_description").alias("description"),
                         F.left("weather_description", F.lit(2)).alias("icon"))).alias("weather"),
        F.lit("stations").alias("base"),
        F.struct(F.col("main_temp").alias("temp"), F.col("main_feels_like").alias("feels_like"),
                 F.col("main_temp_min").alias("temp_min"), F.col("main_temp_max").alias("temp_max"),
                 F.col("main_pressure").alias("pressure"), F.col("main_humidity").alias("humidity"),
                 (F.col("main_pressure") - 7).alias("grnd_level")).alias("main"),
        "visibility",
        F.struct(F.col("wind_speed").alias("speed"), F.col("wind_deg").alias("deg")).alias("wind"),
        F.struct(F.col("clouds_all").alias("all")).alias("clouds"),
        second.alias("dt"),
        F.struct(F.col("kafka_partition").alias("type"), F.col("main_humidity").alias("id"), F.lit("EG").alias("country"),
                 (day + 21600).alias("sunrise"), (day + 64800).alias("sunset")).alias("sys"),
        (F.col("kafka_partition") * 3600).alias("timezone"),
        F.col("id").cast("int").alias("id"), F.col("governorate").alias("name"), F.lit(200).alias("cod"))
    return rows.select("governorate", "timestamp", "processed_at", F.to_json(answer).alias("json"))


def _messages(rows: DataFrame) -> DataFrame:
    data = flatten_answers(_answers(rows), F.col("timestamp"))
    return envelopes(data, utc_instant("timestamp"))


@query(S.with_readings("""SELECT governorate, kafka_partition, date_trunc('second', "timestamp") AS "timestamp",
    coord_lon, coord_lat, main_humidity AS weather_id, weather_main, weather_description, main_temp, main_feels_like,
    round(main_temp_min, 2) AS main_temp_min, round(main_temp_max, 2) AS main_temp_max, main_pressure, main_humidity, NULL::INT AS main_sea_level,
    visibility, round(wind_speed, 2) AS wind_speed, wind_deg, clouds_all, CAST(id AS INT) AS location_id,
    governorate AS location_name, 200 AS cod, date_trunc('second', recorded_at) AS recorded_at,
    weather_description[1:2] AS weather_icon, 'stations' AS base, main_pressure - 7 AS main_grnd_level, second AS dt,
    kafka_partition AS sys_type, main_humidity AS sys_id, 'EG' AS sys_country, second - second % 86400 + 21600 AS sys_sunrise,
    second - second % 86400 + 64800 AS sys_sunset, kafka_partition * 3600 AS timezone,
    date_trunc('second', "timestamp") + INTERVAL 30 SECOND AS processed_at
    FROM (SELECT *, CAST(floor(epoch("timestamp")) AS BIGINT) AS second FROM readings)""")
       .replace("main_feels_like,\n", "round(main_feels_like, 2) AS main_feels_like,\n", 1))
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested answers flattened, put into messages, parsed and flattened to all 34 columns of the reading table."""
    processed = F.col("timestamp") + F.expr("INTERVAL 30 SECONDS")
    flat = flat_readings(accepted(parse(_messages(readings(spark, sf_dir)))), processed)
    return flat.select(
        "governorate", "kafka_partition", utc_wall_clock("timestamp").alias("timestamp"), "coord_lon", "coord_lat",
        "weather_id", "weather_main", "weather_description", "main_temp", "main_feels_like", "main_temp_min",
        "main_temp_max", "main_pressure", "main_humidity", "main_sea_level", "visibility", "wind_speed", "wind_deg",
        "clouds_all", "location_id", "location_name", "cod", F.col("recorded_at").cast("timestamp_ntz").alias("recorded_at"),
        "weather_icon", "base", "main_grnd_level", "dt", "sys_type", "sys_id", "sys_country", "sys_sunrise", "sys_sunset",
        "timezone", utc_wall_clock("processed_at").alias("processed_at"))


@query(S.with_readings("""SELECT governorate AS key, kafka_partition AS partition,
    governorate AS governorate, CAST(floor(epoch("timestamp")) AS BIGINT) AS epoch,
    strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS datetime, main_temp AS temp,
    strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS recorded_at FROM readings WHERE kafka_partition IS NOT NULL"""))
def envelope_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliverable messages, with fields read back from their JSON text."""
    field = lambda path: F.get_json_object("value", path)
    return deliverable(_messages(readings(spark, sf_dir))).select(
        "key", "partition", field("$.governorate").alias("governorate"),
        field("$.timestamp").cast("bigint").alias("epoch"), field("$.datetime").alias("datetime"),
        field("$.data.main_temp").cast("double").alias("temp"),
        field("$.data.recorded_at").alias("recorded_at"))


@query(S.with_readings("""SELECT 'unknown region' AS reason, count(*) AS n FROM readings WHERE kafka_partition IS NULL
    UNION ALL SELECT 'not a message', count(*) FROM events"""))
def message_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages put aside: regions the stream does not know, and texts that are no messages."""
    unknown = unknown_region(_messages(readings(spark, sf_dir)))
    broken = rejected(parse(load(spark, sf_dir, "events").select(F.col("props").alias("value"))))
    return (unknown.agg(F.count("*").alias("n")).select(F.lit("unknown region").alias("reason"), "n")
            .unionByName(broken.agg(F.count("*").alias("n")).select(F.lit("not a message").alias("reason"), "n")))


# --- file streams ----------------------------------------------------------------------------

def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as a stream of the events files; instants, as watermarks need them."""
    schema = load(spark, sf_dir, "events").schema
    rows = readings_from(jobs.read_files(spark, f"{sf_dir}/events.parquet", schema))
    return rows.withColumns({c: utc_instant(c) for c in ("timestamp", "recorded_at", "processed_at")})


def _result(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Rows the stream has written once its input is used up."""
    place = scratch_path(spark, name)
    jobs.write_files(stream, f"{place}/out", f"{place}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{place}/out")


@query(S.with_readings("""SELECT DISTINCT governorate, date_trunc('minute', "timestamp") AS "timestamp" FROM readings"""))
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First reading per region and minute."""
    minutes = _stream(spark, sf_dir).select("governorate", F.date_trunc("minute", "timestamp").alias("timestamp"))
    done = _result(spark, jobs.distinct_readings(minutes), "dedup")
    return done.withColumn("timestamp", utc_wall_clock("timestamp"))


@query(S.with_readings(f"""SELECT * FROM ({rollup_select('hour', HOURLY_EXTRA)})
    WHERE bucket + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max("timestamp")) - INTERVAL 3 HOUR FROM readings)"""))
def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that lie behind the watermark; the open ones stay in the state."""
    done = _result(spark, jobs.hourly_stream(jobs.distinct_readings(_stream(spark, sf_dir)), delay=None), "hourly")
    return round_hourly(done).withColumn("bucket", utc_wall_clock("bucket"))


@query(S.with_readings(f"""SELECT * FROM ({rollup_select('day', DAILY_EXTRA)})
    WHERE bucket + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max("timestamp")) - INTERVAL 3 DAY FROM readings)"""))
def stream_rollup_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _result(spark, jobs.daily_stream(_stream(spark, sf_dir)), "daily")
    return (rounded(done, 9, "avg_temperature", "avg_humidity", "avg_wind_speed", "avg_pressure")
            .withColumn("bucket", utc_wall_clock("bucket")))


@query(S.with_readings("""SELECT governorate, kafka_partition, "timestamp", main_temp, main_humidity,
    CAST("timestamp" AS DATE) AS period FROM readings"""))
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table that every reading is appended to once, in day folders; the stream holds each one twice."""
    place = scratch_path(spark, "append")
    once = _stream(spark, sf_dir).select("governorate", "kafka_partition", "timestamp", "main_temp", "main_humidity")
    twice = once.unionByName(once)
    jobs.append_readings(twice, f"{place}/table", f"{place}/checkpoint", interval=None).awaitTermination()
    return read_table(spark, f"{place}/table").drop(BATCH).withColumn("timestamp", utc_wall_clock("timestamp"))


_COLUMNS = ("main_temp", "main_humidity", "wind_speed", "weather_main", "kafka_partition")


@query(S.with_readings(f"""SELECT governorate, "timestamp", processed_at, {', '.join(_COLUMNS)} FROM (
    SELECT *, row_number() OVER (PARTITION BY governorate, "timestamp" ORDER BY processed_at DESC, main_temp DESC NULLS LAST) AS rn
    FROM (SELECT * REPLACE (date_trunc('hour', "timestamp") AS "timestamp") FROM readings)) WHERE rn = 1"""))
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table of hourly readings kept by key from micro-batches: the last processed one stays."""
    place = scratch_path(spark, "upsert")
    rows = _stream(spark, sf_dir).select(
        "governorate", F.date_trunc("hour", "timestamp").alias("timestamp"), "processed_at", *_COLUMNS)
    jobs.upsert_readings(rows, f"{place}/table", f"{place}/checkpoint", interval=None).awaitTermination()
    return read_table(spark, f"{place}/table").drop("period").withColumns(
        {c: utc_wall_clock(c) for c in ("timestamp", "processed_at")})


@query(S.with_readings(f"""SELECT governorate, kafka_partition, date_trunc('second', "timestamp") AS "timestamp",
    main_temp, main_humidity, wind_speed FROM readings QUALIFY row_number() OVER (
        PARTITION BY governorate, date_trunc('second', "timestamp")
        ORDER BY {S.newest_first(['main_humidity', 'weather_main', 'weather_description', 'main_temp'])}) = 1"""))
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of all readings through the ingest job to the table, one row per region and second."""
    place = scratch_path(spark, "ingest")
    _messages(readings(spark, sf_dir)).select("value").write.parquet(f"{place}/messages")
    stream = jobs.read_files(spark, f"{place}/messages", spark.read.parquet(f"{place}/messages").schema)
    jobs.ingest_messages(stream, f"{place}/table", f"{place}/quarantine", f"{place}/checkpoint",
                         interval=None).awaitTermination()
    return read_table(spark, f"{place}/table").select(
        "governorate", "kafka_partition", utc_wall_clock("timestamp").alias("timestamp"), "main_temp",
        "main_humidity", "wind_speed")

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from skygauge.functions.times import utc_instant, utc_wall_clock
from skygauge.operators import places, quality, rollups, serving
from skygauge.operators.pruning import newest_day
from skygauge.plans import health, rollup_tables
from skygauge.sources.tables import append_batch, compact_days, read_table, upsert_table
from skygauge.streaming import jobs
from skygauge.streaming.messages import (accepted, deliverable, envelopes, flat_readings, flatten_answers, parse,
                                         rejected, unknown_region)

ANSWER = {
    "coord": {"lon": 31.2357, "lat": 30.0444}, "base": "stations", "visibility": 10000, "dt": 1761746585,
    "weather": [{"id": 800, "main": "Clear", "description": "clear sky", "icon": "01d"}, {"id": 1, "main": "Rain"}],
    "main": {"temp": 301.485, "feels_like": 301.43, "temp_min": 301.07, "temp_max": 301.48, "pressure": 1014,
             "humidity": 44, "sea_level": 1014, "grnd_level": 1008},
    "wind": {"speed": 6.17, "deg": 360}, "clouds": {"all": 0},
    "sys": {"type": 1, "id": 2514, "country": "EG", "sunrise": 1761710794, "sunset": 1761750647},
    "timezone": 10800, "id": 7922173, "name": "Al 'Atabah", "cod": 200,
}


def at(text):
    return F.lit(text).cast("timestamp")


def flat(spark, answer, governorate="Cairo"):
    raw = spark.createDataFrame([(governorate, answer if isinstance(answer, str) else json.dumps(answer))],
                                "governorate STRING, json STRING")
    return flatten_answers(raw, at("2025-10-29 17:08:11"))


def test_answer_is_flattened_to_30_fields(spark):
    data = flat(spark, ANSWER).select("data.*").first().asDict()
    assert len(data) == 30
    assert data["weather_main"] == "Clear" and data["sys_id"] == 2514 and data["id"] == 7922173
    assert data["wind_deg"] == 360 and data["clouds_all"] == 0 and data["recorded_at"] == "2025-10-29 17:08:11"


@pytest.mark.parametrize("answer", [{}, {"weather": []}, {"main": None, "weather": None}, "{bad"])
def test_missing_groups_give_null(spark, answer):
    data = flat(spark, answer).select("data.*").first().asDict()
    assert [k for k, v in data.items() if v is not None] == ["recorded_at"]


def test_message_round_trip(spark):
    messages = envelopes(flat(spark, ANSWER), at("2025-10-29 14:10:00.5"))
    row = messages.first()
    assert (row["key"], row["partition"]) == ("Cairo", 1)
    body = json.loads(row["value"])
    assert (body["timestamp"], body["datetime"]) == (1761747000, "2025-10-29T14:10:00.500000")
    reading = flat_readings(accepted(parse(messages)), at("2025-10-29 14:10:30")).first()
    assert len(reading) == 34
    assert reading["main_temp"] == 301.49 and reading["location_name"] == "Al 'Atabah"
    assert reading["timestamp"] == dt.datetime(2025, 10, 29, 14, 10)
    assert reading["recorded_at"] == dt.datetime(2025, 10, 29, 17, 8, 11)


def test_kelvin_messages_become_celsius(spark):
    parsed = accepted(parse(envelopes(flat(spark, ANSWER), at("2025-10-29 14:10:00"))))
    assert flat_readings(parsed, unit="kelvin").first()["main_temp_max"] == 28.33


def test_unknown_regions_are_put_aside(spark):
    both = envelopes(flat(spark, ANSWER).unionByName(flat(spark, ANSWER, "Sharqia")), at("2025-10-29 14:10:00"))
    assert [r["key"] for r in deliverable(both).collect()] == ["Cairo"]
    assert [r["key"] for r in unknown_region(both).collect()] == ["Sharqia"]


def test_unusable_messages(spark):
    texts = ["{bad", '{"governorate":"Cairo"}', "[]", None,
             '{"governorate":"Cairo","timestamp":1,"data":{"main_pressure":1014.5,"main_temp":3.0}}']
    parsed = parse(spark.createDataFrame([(t,) for t in texts], "value STRING"))
    assert rejected(parsed).count() == 4
    good = accepted(parsed).select("data.main_pressure", "data.main_temp").collect()
    assert [tuple(r) for r in good] == [(None, 3.0)]


def message(governorate, second, temp):
    return json.dumps({"governorate": governorate, "timestamp": second, "datetime": "", "partition": 1,
                       "data": {"main_temp": temp, "recorded_at": "2024-01-01 00:00:00"}})


def land(spark, folder, *texts):
    spark.createDataFrame([(t,) for t in texts], "value STRING").coalesce(1).write.mode("append").parquet(str(folder))


def run_ingest(spark, tmp_path):
    stream = jobs.read_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema,
                             files_per_trigger=1)
    jobs.ingest_messages(stream, str(tmp_path / "table"), str(tmp_path / "aside"), str(tmp_path / "check"),
                         interval=None).awaitTermination()
    return read_table(spark, str(tmp_path / "table"))


def test_ingest_over_several_batches_and_a_restart(spark, tmp_path):
    land(spark, tmp_path / "in", message("Cairo", 100, 1.0), message("Giza", 100, 2.0), "{bad")
    land(spark, tmp_path / "in", message("Cairo", 100, 1.5), message("Cairo", 90000, 4.0))
    assert run_ingest(spark, tmp_path).count() == 3
    land(spark, tmp_path / "in", message("Giza", 100, 7.0))          # sent again: the last one stays
    table = run_ingest(spark, tmp_path)
    temps = {(r["governorate"], r["timestamp"].day): r["main_temp"] for r in table.collect()}
    assert temps == {("Cairo", 1): 1.5, ("Giza", 1): 7.0, ("Cairo", 2): 4.0}
    assert spark.read.parquet(str(tmp_path / "aside")).count() == 1
    assert sorted(p.name for p in (tmp_path / "table").glob("period=*")) == ["period=1970-01-01", "period=1970-01-02"]


def test_append_writes_each_reading_once(spark, tmp_path):
    def run():
        stream = jobs.read_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema,
                                 files_per_trigger=1)
        readings = flat_readings(accepted(parse(stream)), F.current_timestamp())
        jobs.append_readings(readings, str(tmp_path / "t"), str(tmp_path / "c"), interval=None).awaitTermination()
        return sorted((r["governorate"], r["main_temp"]) for r in read_table(spark, str(tmp_path / "t")).collect())

    land(spark, tmp_path / "in", message("Cairo", 100, 1.0), message("Cairo", 100, 1.0), message("Giza", 90000, 2.0))
    assert run() == [("Cairo", 1.0), ("Giza", 2.0)]
    kept = {p.name for p in (tmp_path / "t").rglob("*.parquet")}
    land(spark, tmp_path / "in", message("Giza", 90000, 2.0), message("Giza", 90001, 3.0))
    assert run() == [("Cairo", 1.0), ("Giza", 2.0), ("Giza", 3.0)]
    assert kept < {p.name for p in (tmp_path / "t").rglob("*.parquet")}        # nothing was rewritten
    now = F.lit("1970-01-02 01:30:00").cast("timestamp")
    assert health.check_table(spark, str(tmp_path / "t"), now).first()["records"] == 2


def test_appended_batches_are_replaced_and_compacted(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *days: spark.createDataFrame([(f"g{k}", dt.datetime(2024, 1, n), float(k)) for n in days for k in range(50)],
                                               "governorate STRING, timestamp TIMESTAMP, v DOUBLE").repartition(8)
    for batch, days in enumerate([(1, 2), (2, 3), (3,)]):
        append_batch(rows(*days), path, batch, "timestamp", ["timestamp"])
    append_batch(rows(2, 3), path, 1, "timestamp", ["timestamp"])             # comes again
    count = lambda: read_table(spark, path).groupBy("period").count().orderBy("period").collect()
    before = [(str(r["period"]), r["count"]) for r in count()]
    assert before == [("2024-01-01", 50), ("2024-01-02", 100), ("2024-01-03", 100)]
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 5                # one file for a batch and day
    assert compact_days(spark, path, "2024-01-03", ["timestamp"]) == 2
    assert compact_days(spark, path, "2024-01-03", ["timestamp"]) == 0
    assert [(str(r["period"]), r["count"]) for r in count()] == before
    assert sorted(p.name for p in (tmp_path / "t" / "period=2024-01-02").iterdir()) == ["batch_id=-1"]
    wider = rows(4).withColumn("note", F.lit("x"))
    append_batch(wider, path, 3, "timestamp", ["timestamp"])
    assert read_table(spark, path).filter("note = 'x'").count() == 50 and read_table(spark, path).count() == 300
    append_batch(rows(4).limit(0), path, 4, "timestamp", ["timestamp"])
    assert read_table(spark, path).count() == 300


READING = ("governorate STRING, kafka_partition INT, timestamp TIMESTAMP_NTZ, main_temp DOUBLE, main_temp_min DOUBLE, "
           "main_temp_max DOUBLE, main_humidity INT, wind_speed DOUBLE, main_pressure INT, visibility INT, clouds_all INT")


def reading(g, time, temp=20.0, partition=0):
    return (g, partition, f"2024-01-01 {time}", temp, temp - 1, temp + 1, 50, 3.0, 1010, 9000, 10)


def test_stream_rollup_equals_the_batch_on_closed_hours(spark, ntz, tmp_path):
    rows = ntz([reading("Cairo", f"{h:02d}:{m:02d}:00", float(h + m)) for h in range(12) for m in (5, 35)]
               + [reading("Giza", "03:00:00"), reading("Giza", "03:00:00")], READING)
    rows = rows.withColumn("timestamp", utc_instant("timestamp"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = jobs.read_files(spark, str(tmp_path / "in"), rows.schema)
    hourly = jobs.hourly_stream(jobs.distinct_readings(stream), delay=None)
    jobs.write_files(hourly, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = spark.read.schema(hourly.schema).parquet(str(tmp_path / "out"))
    batch = rollups.weather_hourly(rows.dropDuplicates(["governorate", "timestamp"]))
    # The newest reading is 11:35, so hours that end by 08:35 are closed.
    closed = batch.filter(utc_wall_clock("bucket") <= F.lit("2024-01-01 07:00:00").cast("timestamp_ntz"))
    key = lambda df: sorted(map(tuple, df.select(*batch.columns).collect()), key=repr)
    assert key(got) == key(closed) and got.count() == 9


def test_late_reading_beyond_the_watermark_is_ignored(spark, ntz, tmp_path):
    def land_rows(*data):
        rows = ntz(list(data), READING).withColumn("timestamp", utc_instant("timestamp"))
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        return rows.schema

    def run(schema):
        stream = jobs.hourly_stream(jobs.read_files(spark, str(tmp_path / "in"), schema, files_per_trigger=1))
        jobs.write_files(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        return {utc.hour: n for utc, n in spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
                .select(utc_wall_clock("bucket"), "reading_count").collect()}

    schema = land_rows(reading("Cairo", "01:00:00"), reading("Cairo", "10:00:00"))
    assert run(schema) == {1: 1}
    land_rows(reading("Cairo", "01:30:00"), reading("Cairo", "08:00:00"), reading("Cairo", "20:00:00"))
    assert run(schema) == {1: 1, 8: 1, 10: 1}


def test_refresh_recomputes_only_its_range(spark, ntz):
    early = ntz([reading("Cairo", "01:00:00", 1.0), reading("Cairo", "02:00:00", 1.0)], READING)
    late = ntz([reading("Cairo", "01:30:00", 3.0), reading("Cairo", "02:30:00", 3.0)], READING)
    hour = lambda h: F.lit(f"2024-01-01 {h:02d}:00:00").cast("timestamp_ntz")
    rows = early.unionByName(late)
    got = rollups.refresh_rollup(rollups.weather_hourly(early), rows, rollups.weather_hourly, hour(2), hour(3))
    assert {r["bucket"].hour: (r["reading_count"], r["avg_temperature"]) for r in got.collect()} == {
        1: (1, 1.0), 2: (2, 2.0)}
    start, end = rollups.refresh_range(rows, rollups.HOURLY, "3 HOURS", "1 HOUR")
    assert rows.select(start, end).first() == (dt.datetime(2023, 12, 31, 23), dt.datetime(2024, 1, 1, 1))


def test_refresh_of_a_stored_rollup(spark, ntz, tmp_path):
    rows = ntz([reading("Cairo", "01:00:00", 1.0), reading("Giza", "02:00:00", 1.0)], READING)
    later = rows.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY"))
    hour = lambda h, day=1: F.lit(f"2024-01-{day:02d} {h:02d}:00:00").cast("timestamp_ntz")
    path = str(tmp_path / "hourly")
    rollup_tables.refresh(rows.unionByName(later), path, "weather_hourly", hour(0), hour(0, 3))
    assert read_table(spark, path).count() == 4
    untouched = sorted(p.name for p in (tmp_path / "hourly" / "period=2024-01-02").glob("*.parquet"))
    # The reading of Giza is gone from the source, and Cairo has one more.
    changed = ntz([reading("Cairo", "01:00:00", 1.0), reading("Cairo", "02:10:00", 5.0)], READING)
    rollup_tables.refresh(changed, path, "weather_hourly", hour(2), hour(3))
    got = {(r["governorate"], r["bucket"].day, r["bucket"].hour) for r in read_table(spark, path).collect()}
    assert got == {("Cairo", 1, 1), ("Cairo", 1, 2), ("Cairo", 2, 1), ("Giza", 2, 2)}
    assert sorted(p.name for p in (tmp_path / "hourly" / "period=2024-01-02").glob("*.parquet")) == untouched
    rollup_tables.refresh(changed, path, "weather_hourly", hour(0, 2), hour(0, 3))     # a day without readings
    assert read_table(spark, path).filter("period > '2024-01-01'").count() == 0
    rollup_tables.scheduled_refresh(changed, path, "weather_hourly")
    assert read_table(spark, path).count() == 2


@pytest.mark.parametrize("instant", [False, True])
def test_stored_tables_do_not_depend_on_the_session_zone(spark, ntz, tmp_path, instant):
    """Written in one zone, refreshed, upserted, read and pruned in another."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = ntz([reading("Cairo", "01:00:00", 1.0), reading("Cairo", "23:30:00", 2.0)], READING)
    rows = rows.withColumn("processed_at", F.col("timestamp"))
    convert = utc_instant if instant else F.col

    def hour(h):
        wall_clock = F.lit(f"2024-01-01 {h:02d}:00:00").cast("timestamp_ntz")
        return utc_instant(wall_clock) if instant else wall_clock
    table, hourly = str(tmp_path / "t"), str(tmp_path / "h")
    try:
        for name in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            data = rows.withColumn("timestamp", convert("timestamp"))
            upsert_table(data, table, ["timestamp", "governorate"], ["processed_at"], "timestamp", grain="day")
            stored = read_table(spark, table)
            rollup_tables.refresh(stored, hourly, "weather_hourly", hour(0), hour(2))
            assert stored.count() == 2
            assert read_table(spark, hourly).count() == 1
            assert [r["main_temp"] for r in serving.since(stored, stored, "1 HOUR").collect()] == [2.0]
            assert [r["main_temp"] for r in serving.latest_weather(
                stored.withColumns({c: F.lit(1) for c in serving.LATEST_COLUMNS if c not in stored.columns})).collect()] == [2.0]
            assert rollups.retained(stored, stored, days=0).count() == 2
        assert [p.name for p in (tmp_path / "t").glob("period=*")] == ["period=2024-01-01"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_health(spark, ntz, tmp_path):
    now = F.lit("2024-01-01 02:00:00").cast("timestamp_ntz")
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        health.check_table(spark, path, now)
    rows = ntz([reading("Cairo", "01:30:00"), reading("Cairo", "00:30:00")], READING)
    rows.withColumn("processed_at", F.col("timestamp")).write.parquet(path)
    assert tuple(health.check_table(spark, path, now).first()) == (1, dt.datetime(2024, 1, 1, 1, 30))
    assert not health.check_arrivals(spark, path, now)
    assert health.check_arrivals(spark, path, now, "31 MINUTES")
    assert health.check_quality(spark, path, now).first()["total_records"] == 2
    assert health.metrics(spark, path).first()["unique_governorates"] == 1


def test_newest_of_regions_keeps_silent_regions(spark, ntz):
    rows = ntz([reading("Cairo", f"{h:02d}:00:00", float(h)) for h in range(24)] + [reading("Giza", "00:00:00", 9.0)], READING)
    got = serving.newest_of_regions(rows, "timestamp", ["governorate", "timestamp", "main_temp"])
    assert {r["governorate"]: r["main_temp"] for r in got.collect()} == {"Cairo": 23.0, "Giza": 9.0}


def test_recent_queries_leave_out_old_day_folders(spark, ntz, tmp_path):
    rows = ntz([reading("Cairo", "01:00:00")], READING)
    rows = rows.unionByName(rows.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 40 DAYS")))
    rows = rows.withColumns({c: F.col("timestamp") for c in ("recorded_at", "processed_at")}).withColumns(
        {c: F.lit("x") for c in ("weather_main", "weather_description")}).withColumn("main_feels_like", F.lit(1.0))
    path = str(tmp_path / "t")
    upsert_table(rows, path, ["timestamp", "governorate"], ["processed_at"], "timestamp", grain="day")
    stored = read_table(spark, path)
    for df, count in ((serving.since(stored, stored, "1 HOUR"), 1), (serving.latest_weather(stored), 1),
                      (rollups.retained(stored, stored, days=90), 2), (rollups.retained(stored, stored, days=10), 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert any("PartitionFilters: [isnotnull(period" in line for line in plan.splitlines())
        assert df.count() == count
    last = newest_day(stored, "timestamp")
    assert [r["timestamp"] for r in last.collect()] == [dt.datetime(2024, 2, 10, 1)]
    assert newest_day(stored.drop("period"), "timestamp").count() == 2
    assert newest_day(stored.limit(0), "timestamp").count() == 0
    edges = lambda df: spark.range(1).select(*rollups.refresh_range(df, "1 hour", "3 HOURS", "1 HOUR")).first()
    assert tuple(edges(stored)) == tuple(edges(stored.drop("period")))
    start, end = (F.lit(f"2024-01-01 {t}").cast("timestamp_ntz") for t in ("00:00:00", "02:00:00"))
    assert serving.in_range(stored, start, end, "timestamp").count() == 1


def test_retention_keeps_whole_days(spark, ntz):
    rows = ntz([("2024-01-01 23:59:59",), ("2024-01-02 00:00:00",), ("2024-01-04 12:00:00",)], "timestamp TIMESTAMP_NTZ")
    kept = rollups.retained(rows, F.lit("2024-01-04 12:00:00").cast("timestamp_ntz"), days=2)
    assert kept.count() == 2 == rollups.retained(rows, rows, days=2).count()


def test_sites(spark):
    assert quality.complete_sites(places.sites(spark)).count() == 27
    odd = spark.createDataFrame([("A", 0.0, 1.0), (None, 1.0, 1.0), ("", 1.0, 1.0), ("B", 1.0, None)],
                                "name STRING, lat DOUBLE, lon DOUBLE")
    assert quality.complete_sites(odd).count() == 0
    assert places.members_of(spark, 1).count() == 9
    with pytest.raises(ValueError):
        places.members_of(spark, 3)


def test_write_by_partition(spark, ntz, tmp_path):
    rows = ntz([reading("Cairo", "01:00:00"), reading("Luxor", "01:00:00"), reading("Sharqia", "01:00:00")], READING)
    places.write_by_partition(rows.drop("kafka_partition"), str(tmp_path / "t"))
    assert sorted(p.name for p in (tmp_path / "t").glob("kafka*")) == ["kafka_partition=1", "kafka_partition=2"]


def test_quality_issues(spark, ntz):
    few = ntz([reading("Cairo", "01:00:00", 70.0)], READING)
    assert quality.quality_summary(few).first()["issues"] == [
        "Low governorate coverage: 1/27", "Low record count: 1", "Suspicious avg_temp: 70.0"]
    assert quality.quality_summary(few.limit(0)).first()["issues"] == [
        "Low governorate coverage: 0/27", "Low record count: 0"]


def test_region_pattern_must_match_whole_names(spark, ntz):
    rows = ntz([reading("Cairo", "01:00:00"), reading("New Cairo", "01:00:00"), reading("Giza", "01:00:00")], READING)
    names = lambda p: sorted(r["governorate"] for r in serving.match_region(rows, p).collect())
    assert names("Cairo|Giza") == ["Cairo", "Giza"]
    assert len(names(".*")) == 3

"""Readings that are restated: deltas of micro-batches, merged when they are read."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from skygauge.operators.rollups import weather_hourly
from skygauge.plans.rollup_tables import POLICIES, refresh_invalid
from skygauge.sources.deltas import compact_deltas, merged_between, open_days
from skygauge.sources.tables import read_table, replace_range
from skygauge.streaming import jobs

SCHEMA = ("governorate STRING, kafka_partition INT, timestamp TIMESTAMP, main_temp DOUBLE, main_temp_min DOUBLE, "
          "main_temp_max DOUBLE, main_humidity INT, wind_speed DOUBLE, main_pressure INT, visibility INT, clouds_all INT, "
          "recorded_at TIMESTAMP, processed_at TIMESTAMP")


def at(text):
    return None if text is None else dt.datetime.fromisoformat(f"2024-01-{text}")


def reading(region, time, temp=20.0, processed=None):
    return region, 0, at(time), temp, temp - 1, temp + 1, 50, 3.0, 1010, 9000, 10, at(time), at(processed or time)


def arrive(spark, place, *rows, **options):
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(f"{place}/in")
    stream = jobs.read_files(spark, f"{place}/in", spark.createDataFrame([], SCHEMA).schema)
    jobs.merge_readings(stream, f"{place}/t", f"{place}/c", interval=None, **options).awaitTermination()


def current(spark, place):
    return sorted((r.governorate, r.timestamp, r.main_temp) for r in jobs.current_readings(spark, f"{place}/t").collect())


def files(place):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{place}/t/period=*/*/*.parquet")}


def test_the_reading_stated_last_counts_and_nothing_is_rewritten(spark, tmp_path):
    place = str(tmp_path)
    arrive(spark, place, reading("Cairo", "05T12:00", 1.0), reading("Giza", "05T12:00", 2.0), reading("Giza", "04T12:00", 3.0))
    before = files(place)
    arrive(spark, place, reading("Cairo", "05T12:00", 9.0, "05T13:00"), reading("Cairo", "05T12:00", 8.0, "05T12:30"))
    arrive(spark, place, reading("Cairo", "05T12:00", 1.0), reading("Giza", "05T12:00", 2.0))  # old states come again
    after = files(place)
    assert {f: after[f] for f in before} == before
    wanted = [("Cairo", at("05T12:00"), 9.0), ("Giza", at("04T12:00"), 3.0), ("Giza", at("05T12:00"), 2.0)]
    assert current(spark, place) == wanted and open_days(spark, f"{place}/t") == [dt.date(2024, 1, 5)]
    assert compact_deltas(spark, f"{place}/t", "2024-01-06", jobs.READING_KEY, jobs.READING_ORDER) == 2
    assert current(spark, place) == wanted and open_days(spark, f"{place}/t") == []
    arrive(spark, place, reading("Giza", "04T12:00", 4.0, "06T00:00"))
    assert current(spark, place) == [wanted[0], ("Giza", at("04T12:00"), 4.0), wanted[2]]


def test_a_repeated_batch_changes_nothing_before_and_after_compaction(spark, tmp_path):
    place = str(tmp_path)
    rows = spark.createDataFrame([reading("Cairo", "05T12:00", 1.0), reading("Giza", "04T12:00", 2.0)], SCHEMA)
    newer = spark.createDataFrame([reading("Cairo", "05T12:00", 5.0, "05T14:00")], SCHEMA)
    jobs._add_deltas(rows, f"{place}/t", 0, "3 hours")
    jobs._add_deltas(newer, f"{place}/t", 1, "3 hours")
    wanted = current(spark, place)
    jobs._add_deltas(newer, f"{place}/t", 1, "3 hours")
    assert current(spark, place) == wanted == [("Cairo", at("05T12:00"), 5.0), ("Giza", at("04T12:00"), 2.0)]
    compact_deltas(spark, f"{place}/t", "2024-02-01", jobs.READING_KEY, jobs.READING_ORDER)
    jobs._add_deltas(rows, f"{place}/t", 0, "3 hours")
    jobs._add_deltas(newer, f"{place}/t", 1, "3 hours")
    assert current(spark, place) == wanted


def test_readings_without_key_and_foreign_checkpoints(spark, tmp_path):
    place, aside = str(tmp_path), str(tmp_path / "aside")
    good, bad = reading("Cairo", "05T12:00"), [reading(None, "05T12:00"), (*reading("Giza", "05T12:00")[:2], None, *reading("Giza", "05T12:00")[3:])]
    arrive(spark, place, good, *bad, quarantine=aside)
    assert len(current(spark, place)) == 1 and spark.read.parquet(aside).count() == 2
    arrive(spark, place, *bad, quarantine=aside)  # nothing but unusable rows
    assert len(current(spark, place)) == 1 and spark.read.parquet(aside).count() == 4
    with pytest.raises(ValueError, match="checkpoint"):
        jobs.merge_readings(jobs.read_files(spark, f"{place}/in", spark.createDataFrame([], SCHEMA).schema), f"{place}/t", f"{place}/other")
    other = str(tmp_path / "strict")
    with pytest.raises(Exception, match="part of the key"):
        arrive(spark, other, good, *bad)


def test_rollups_follow_restated_readings(spark, tmp_path):
    place = str(tmp_path)
    arrive(spark, place, *[reading("Cairo", f"05T{h:02}:00", float(h)) for h in range(12)])
    target = f"{place}/hourly"
    span = [F.lit(f"2024-0{n}-01").cast("timestamp") for n in (1, 2)]
    replace_range(POLICIES["weather_hourly"].rollup(jobs.current_readings(spark, f"{place}/t")), target, "bucket", *span, ["bucket"])
    arrive(spark, place, reading("Cairo", "05T02:00", 40.0, "05T12:00"), reading("Cairo", "05T03:30", 50.0), delay="1 hour")
    readings = jobs.current_readings(spark, f"{place}/t")
    assert refresh_invalid(spark, f"{place}/t", {"weather_hourly": target}, readings) == 2
    rows = lambda df: sorted((r.bucket, r.governorate, r.reading_count, r.avg_temperature) for r in df.collect())
    assert rows(read_table(spark, target)) == rows(weather_hourly(readings))
    assert refresh_invalid(spark, f"{place}/t", {"weather_hourly": target}, readings) == 0


def test_a_span_of_processing_times_opens_its_days_and_takes_the_last_state(spark, tmp_path):
    place = str(tmp_path)
    arrive(spark, place, *[reading("Cairo", f"{d:02}T12:00", float(d)) for d in range(1, 9)])
    arrive(spark, place, reading("Cairo", "03T12:00", 30.0, "07T18:00"))
    between = [F.lit(f"2024-01-{t}").cast("timestamp") for t in ("03 00:00:00", "04 23:00:00")]
    some = merged_between(spark, f"{place}/t", jobs.READING_KEY, jobs.READING_ORDER, "processed_at", *between)
    assert [r.main_temp for r in some.collect()] == [4.0]  # the third day's reading was stated anew, later
    scans = [line for line in some._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]
    assert scans and all("2024-01-04" in line and "2024-01-08" not in line for line in scans)
    late = merged_between(spark, f"{place}/t", jobs.READING_KEY, jobs.READING_ORDER, "processed_at", F.lit("2024-01-07 13:00:00").cast("timestamp"))
    assert sorted(r.main_temp for r in late.collect()) == [8.0, 30.0]
    none = merged_between(spark, f"{place}/t", jobs.READING_KEY, jobs.READING_ORDER, "processed_at", F.lit("2025-01-01").cast("timestamp"))
    assert none.collect() == []


def test_messages_become_deltas(spark, tmp_path):
    place = str(tmp_path)
    message = {"governorate": "Cairo", "timestamp": 1704456000, "datetime": "", "partition": 1,
               "data": {"main_temp": 21.0, "recorded_at": "2024-01-05 12:00:00"}}
    sent = spark.createDataFrame([(json.dumps(message),), ("no message",)], "value STRING").coalesce(1)
    for _ in range(2):  # the same messages twice
        sent.write.mode("append").parquet(f"{place}/in")
    stream = jobs.read_files(spark, f"{place}/in", sent.schema, files_per_trigger=1)
    jobs.ingest_messages(stream, f"{place}/t", f"{place}/aside", f"{place}/c", interval=None, merge_on_read=True).awaitTermination()
    assert [(r[0], r[2]) for r in current(spark, place)] == [("Cairo", 21.0)]
    assert len(files(place)) == 2 and spark.read.parquet(f"{place}/aside").count() == 2

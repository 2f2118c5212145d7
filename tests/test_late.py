"""Late, repeated and unusable readings in the append sink, and what is kept beside its table."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from skygauge.plans import health
from skygauge.plans.latest_view import latest_view, merge_latest, rebuild_latest
from skygauge.plans.rollup_tables import POLICIES, refresh_invalid
from skygauge.sources import ranges, snapshots
from skygauge.sources.tables import append_batch, compact_days, read_table, replace_range, upsert_table, with_period
from skygauge.streaming import jobs

SCHEMA = ("governorate STRING, kafka_partition INT, timestamp TIMESTAMP, main_temp DOUBLE, main_temp_min DOUBLE, "
          "main_temp_max DOUBLE, main_humidity INT, wind_speed DOUBLE, main_pressure INT, visibility INT, clouds_all INT, "
          "recorded_at TIMESTAMP, processed_at TIMESTAMP")


def at(text):
    return None if text is None else dt.datetime.fromisoformat(f"2024-01-{text}")


def reading(region, time, temp=20.0, recorded=None):
    clock = at(recorded or time)
    return region, 0, at(time), temp, temp - 1, temp + 1, 50, 3.0, 1010, 9000, 10, clock, clock


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def arrive(spark, tmp_path, *rows, **options):
    frame(spark, rows).repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.read_files(spark, str(tmp_path / "in"), frame(spark, []).schema)
    jobs.append_readings(stream, str(tmp_path / "t"), str(tmp_path / "c"), interval=None, **options).awaitTermination()
    return sorted((r.governorate, r.timestamp, r.main_temp) for r in read_table(spark, str(tmp_path / "t")).collect())


def rows_of(*readings):
    return sorted((r[0], r[2], r[3]) for r in readings)


def test_no_reading_is_lost_or_stored_twice(spark, tmp_path):
    aside, view = str(tmp_path / "aside"), str(tmp_path / "latest")
    first = [reading("Cairo", "05T12:00", 1.0), reading("Giza", "05T12:00", 2.0)]
    assert arrive(spark, tmp_path, *first, first[0], quarantine=aside, latest=view) == rows_of(*first)
    second = [reading("Cairo", "05T13:00", 3.0)]
    assert arrive(spark, tmp_path, *second, quarantine=aside, latest=view) == rows_of(*first, *second)
    late = [reading("Cairo", "05T02:00", 4.0), reading("Giza", "05T04:00", 5.0), reading("Giza", "03T23:59", 6.0)]
    bad = [reading(None, "05T13:30", 7.0), reading("Giza", None, 8.0, "05T13:30"), reading(None, None, 9.0, "05T13:30")]
    got = arrive(spark, tmp_path, *late, *late, *first, *second, *bad, quarantine=aside, latest=view)
    assert got == rows_of(*first, *second, *late)
    again = [*late, reading("Cairo", "02T00:00", 10.0), reading("Cairo", "05T10:00", 11.0)]  # at the watermark itself
    assert arrive(spark, tmp_path, *again, quarantine=aside, latest=view) == rows_of(*first, *second, *late, *again[3:])
    assert spark.read.parquet(aside).count() == 3
    newest = {r.governorate: (r.timestamp, r.main_temp) for r in latest_view(spark, view).collect()}
    assert newest == {"Cairo": (at("05T13:00"), 3.0), "Giza": (at("05T12:00"), 2.0)}


def test_of_late_rows_with_one_key_the_last_processed_stays(spark, tmp_path):
    arrive(spark, tmp_path, reading("Cairo", "05T12:00"))
    got = arrive(spark, tmp_path, reading("Giza", "01T00:00", 1.0, "05T12:01"), reading("Giza", "01T00:00", 0.5, "05T12:02"))
    assert ("Giza", at("01T00:00"), 0.5) in got and len(got) == 2


def test_rows_without_key_need_a_quarantine(spark, tmp_path):
    with pytest.raises(Exception, match="no quarantine"):
        arrive(spark, tmp_path, reading(None, "05T12:00"))


def test_a_new_checkpoint_is_refused(spark, tmp_path):
    arrive(spark, tmp_path, reading("Cairo", "05T12:00"))
    shutil.rmtree(tmp_path / "c")
    with pytest.raises(ValueError, match="another checkpoint"):
        arrive(spark, tmp_path, reading("Giza", "05T12:00"))


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    arrive(spark, tmp_path, reading("Cairo", "05T12:00", 1.0))
    got = arrive(spark, tmp_path, reading("Cairo", "05T01:00", 2.0), reading("Cairo", "05T12:30", 3.0), latest=str(tmp_path / "l"))
    commits = sorted((p for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for p in commits[-1:]:  # as if the driver had died before it noted the batch
        os.remove(p)
        if os.path.exists(crc := p.parent / f".{p.name}.crc"):
            os.remove(crc)
    assert arrive(spark, tmp_path, latest=str(tmp_path / "l")) == got
    assert latest_view(spark, str(tmp_path / "l")).count() == 1


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "PartitionFilters: [" in line and "PartitionFilters: []" not in line]


def test_ranges_name_the_days_to_open(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda n, recorded: frame(spark, [reading("Cairo", f"{n:02d}T12:00", float(n), recorded)])
    for n, recorded in ((1, "01T12:01"), (2, "02T12:01"), (3, "09T08:00"), (4, "04T12:01")):  # the third came days later
        rows = day(n, recorded)
        ranges.widen_ranges(with_period(rows, "timestamp"), path, n)
        append_batch(rows, path, n, "timestamp", ["timestamp"])
    start, end = F.lit("2024-01-04 00:00:00").cast("timestamp"), F.lit("2024-01-09 23:00:00").cast("timestamp")
    assert [str(p) for p in ranges.periods_between(spark, path, "recorded_at", start, end)] == ["2024-01-03", "2024-01-04"]
    found = ranges.read_between(spark, path, "recorded_at", start, end)
    assert sorted(r.main_temp for r in found.collect()) == [3.0, 4.0] and partition_filters(found)
    none = ranges.read_between(spark, path, "recorded_at", end, end)
    assert none.collect() == []
    assert ranges.periods_between(spark, path, "dt", start, end) is None
    assert spark.range(1).select(ranges.newest_value(spark, path, "recorded_at")).first()[0] == at("09T08:00")
    assert health.check_arrivals(spark, path, F.lit("2024-01-09 08:00:10").cast("timestamp"))
    assert not health.check_arrivals(spark, path, F.lit("2024-01-09 08:00:30").cast("timestamp"))


def test_an_index_that_comes_later_covers_older_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(frame(spark, [reading("Cairo", "01T12:00", 1.0)]), path, ["timestamp", "governorate"], ["processed_at"],
                 "timestamp", grain="day")
    ranges.widen_ranges(with_period(frame(spark, [reading("Giza", "02T12:00", 2.0)]), "timestamp"), path)
    start, end = F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit("2024-01-01 23:00:00").cast("timestamp")
    assert [r.main_temp for r in ranges.read_between(spark, path, "recorded_at", start, end).collect()] == [1.0]


def test_latest_view_merges_in_any_order_and_reads_no_history(spark, tmp_path):
    view, path = str(tmp_path / "v"), str(tmp_path / "t")
    with pytest.raises(ValueError):
        latest_view(spark, view)
    rows = [reading("Cairo", "05T12:00", 1.0), reading("Cairo", "06T12:00", 2.0), reading("Giza", "04T12:00", 3.0),
            reading(None, "07T12:00", 4.0), reading("Suez", None, 5.0, "05T12:00")]
    for k, row in enumerate([rows[1], rows[0], rows[2], rows[3], rows[4], rows[1]]):
        merge_latest(frame(spark, [row]), view, k)
        merge_latest(frame(spark, [row]), view, k)  # comes again
    wanted = {("Cairo", 2.0), ("Giza", 3.0)}
    assert {(r.governorate, r.main_temp) for r in latest_view(spark, view).collect()} == wanted
    assert snapshots.versions(spark, view) == [4, 5]
    append_batch(frame(spark, rows[:3]), path, 0, "timestamp", ["timestamp"])
    rebuild_latest(read_table(spark, path), view)
    got = latest_view(spark, view)
    assert {(r.governorate, r.main_temp) for r in got.collect()} == wanted
    assert all(f"{view}/" in f for f in got.inputFiles())


def test_late_hours_are_refreshed_from_their_days_only(spark, tmp_path):
    start = [reading("Cairo", "02T10:00", 1.0), reading("Cairo", "03T10:00", 2.0), reading("Cairo", "05T12:00", 3.0)]
    arrive(spark, tmp_path, *start)
    path, targets = str(tmp_path / "t"), {name: str(tmp_path / name) for name in POLICIES}
    lo, hi = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    for name, target in targets.items():
        replace_range(POLICIES[name].rollup(read_table(spark, path)), target, "bucket", lo, hi, ["bucket"])
    assert refresh_invalid(spark, path, targets) == 0
    arrive(spark, tmp_path, reading("Cairo", "03T10:30", 4.0), reading("Giza", "03T23:30", 5.0), reading("Giza", "05T12:30", 6.0))
    for file in (tmp_path / "t" / "period=2024-01-02").rglob("*.parquet"):
        file.write_bytes(b"not to be read")
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "weather_daily" / "period=2024-01-02").glob("*.parquet")}
    assert refresh_invalid(spark, path, targets) == 2
    assert refresh_invalid(spark, path, targets) == 0
    assert kept and kept == {p: p.stat().st_mtime_ns for p in (tmp_path / "weather_daily" / "period=2024-01-02").glob("*.parquet")}
    hourly = {(r.governorate, r.bucket): (r.reading_count, r.avg_temperature) for r in read_table(spark, targets["weather_hourly"]).collect()}
    assert hourly == {("Cairo", at("02T10:00")): (1, 1.0), ("Cairo", at("03T10:00")): (2, 3.0), ("Giza", at("03T23:00")): (1, 5.0),
                      ("Cairo", at("05T12:00")): (1, 3.0)}  # the open hour is left to the next scheduled refresh
    daily = {(r.governorate, r.bucket.day): r.reading_count for r in read_table(spark, targets["weather_daily"]).collect()}
    assert daily == {("Cairo", 2): 1, ("Cairo", 3): 2, ("Giza", 3): 1, ("Cairo", 5): 1}


def test_compaction_keeps_what_comes_meanwhile(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for batch in range(3):
        append_batch(frame(spark, [reading(f"g{batch}", "02T10:00")]), path, batch, "timestamp", ["timestamp"])
    from skygauge.sources import tables
    move = tables._move

    def interrupted(*args):
        append_batch(frame(spark, [reading("late", "02T11:00")]), path, 3, "timestamp", ["timestamp"])
        monkeypatch.setattr(tables, "_move", move)
        raise OSError("stopped")

    monkeypatch.setattr(tables, "_move", interrupted)
    with pytest.raises(OSError):
        compact_days(spark, path, "2024-01-03", ["timestamp"])
    assert compact_days(spark, path, "2024-01-03", ["timestamp"]) == 1  # completes the stopped one, then merges the late batch
    assert sorted(r.governorate for r in read_table(spark, path).collect()) == ["g0", "g1", "g2", "late"]
    assert [p.name for p in (tmp_path / "t" / "period=2024-01-02").iterdir()] == ["batch_id=-2"]


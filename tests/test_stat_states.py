"""Partial states of statistics against statistics of the readings themselves."""

import datetime as dt
import math

from pyspark.sql import functions as F

from skygauge.operators import quality, rollups
from skygauge.plans import stat_states
from skygauge.sources.tables import read_table

READINGS = ("governorate STRING, kafka_partition INT, timestamp TIMESTAMP, main_temp DOUBLE, main_temp_min DOUBLE, "
            "main_temp_max DOUBLE")


def made(spark, first, count):
    rows = []
    for k in range(first, first + count):
        temp = None if k % 17 == 0 else 1e6 + k * 7919 % 1000 / 97.0   # a large mean, small deviations
        at = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k * 37 % 6000)
        rows.append((f"g{k % 5}", None if k % 5 == 4 else k % 2, at, temp, None if temp is None else temp - 1, temp))
    rows.append(("lone", 7, dt.datetime(2024, 1, 2), 5.0, 4.0, 6.0) if first else ("empty", 7, dt.datetime(2024, 1, 2), None, None, None))
    return spark.createDataFrame(rows, READINGS).repartition(3)


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-11, abs_tol=1e-9)
    return a == b


def same(got, wanted):
    got, wanted = (sorted((tuple(r) for r in df.select(*sorted(wanted.columns)).collect()), key=str) for df in (got, wanted))
    return len(got) == len(wanted) and all(all(map(close, a, b)) for a, b in zip(got, wanted))


def test_merged_states_equal_statistics_of_the_readings(spark, tmp_path):
    path = str(tmp_path / "states")
    batches = [made(spark, 0, 300), made(spark, 300, 300), made(spark, 600, 50)]
    for k, rows in enumerate(batches):
        stat_states.append_states(rows, path, k)
    stat_states.append_states(batches[1], path, 1)   # comes again
    everything = batches[0].unionByName(batches[1]).unionByName(batches[2])

    def check():
        assert same(stat_states.region_statistics(spark, path), rollups.governorate_temperature_stats(everything))
        assert same(stat_states.partition_statistics(spark, path), rollups.partition_stats(everything))
        assert same(stat_states.reading_metrics(spark, path), quality.ingest_metrics(everything))

    check()
    before = read_table(spark, path).count()
    assert stat_states.compact_states(spark, path, "2024-01-04") == 3
    assert read_table(spark, path).count() < before
    check()
    one = read_table(spark, path).filter("period < '2024-01-04'").groupBy("hour", "governorate", "kafka_partition").count()
    assert one.agg(F.max("count")).first()[0] == 1


def test_states_of_no_readings(spark, tmp_path):
    path = str(tmp_path / "states")
    stat_states.append_states(made(spark, 0, 1).limit(0), path, 0)
    assert stat_states.region_statistics(spark, path).collect() == []
    assert tuple(stat_states.reading_metrics(spark, path).first()) == (0, 0, None, None)

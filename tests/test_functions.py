import datetime as dt
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skygauge import lookups as L
from skygauge.functions.bands import classify, region_class, season, status
from skygauge.functions.keys import date_key, surrogate_key, timestamp_text
from skygauge.functions.names import batch_spelling, canonical_name, partition_of
from skygauge.functions.times import (bucket, from_epoch, from_parts, from_parts_text, seconds_between,
                                      to_epoch, ts_literal, utc_instant, utc_wall_clock)
from skygauge.functions.units import in_celsius


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


@pytest.mark.parametrize("rules, cases", [
    (L.TEMPERATURE_RULES, {9.99: "Cold", 10.0: "Mild", 20.0: "Warm", 30.0: "Hot", None: "Unknown"}),
    (L.HUMIDITY_RULES, {29.9: "Dry", 30.0: "Comfortable", 60.0: "Humid", None: "Unknown"}),
    (L.PRECIPITATION_RULES, {0.0: "No Rain", -1.0: "Light Rain", 2.5: "Moderate Rain", 10.0: "Heavy Rain",
                             2.49: "Light Rain", None: "Unknown"}),
    (L.AIR_QUALITY_RULES, {0.0: "Good", 1.0: "Good", 1.5: "Fair", 5.0: "Very Poor", 6.0: "Unknown",
                           None: "Unknown"}),
    (L.UV_INDEX_RULES, {-999.0: "Low", 10.0: "Very High", 10.1: "Extreme", None: "Unknown"}),
])
def test_category_edges(spark, rules, cases):
    df = spark.createDataFrame([(v,) for v in cases], "v DOUBLE")
    assert values(df, classify("v", rules)) == list(cases.values())


def test_status_colours(spark):
    df = spark.createDataFrame([(v,) for v in (14.9, 15.0, 25.0, 35.0, None)], "v DOUBLE")
    assert values(df, status("v", "temperature")) == ["blue", "green", "orange", "red", None]
    df = spark.createDataFrame([(v,) for v in (1009, 1010, 1020)], "v INT")
    assert values(df, status("v", "pressure")) == ["blue", "green", "yellow"]
    df = spark.createDataFrame([(v,) for v in (4.9, 5.0, 10.0)], "v DOUBLE")
    assert values(df, status("v", "latency")) == ["green", "yellow", "red"]


def test_names_per_source(spark):
    df = spark.createDataFrame([(c,) for c in (
        " alex ", "Siwah", "Sharkia", "gulf of suez", "Sharm _al-Shaykh", "Cairo", None)], "c STRING")
    assert values(df, canonical_name("c", "weather")) == [
        "ALEXANDRIA", "MATROUH", "SHARQIA", None, "SOUTH SINAI", "CAIRO", None]
    assert values(df, canonical_name("c", "solar_energy")) == [
        "ALEXANDRIA", "MATROUH", "SHARKIA", "GULF OF SUEZ", "SOUTH SINAI", "CAIRO", None]
    assert values(df, canonical_name("c", "air_pollution"))[0] == "ALEX"


def test_region_classes_cover_the_listed_names(spark):
    names = [(n, r) for r, members in L.REGION_CLASSES.items() for n in members] + [("GULF OF SUEZ", "Other")]
    df = spark.createDataFrame(names, "n STRING, r STRING")
    assert df.filter(region_class("n") != F.col("r")).count() == 0
    assert len(names) == 28


def test_partitions(spark):
    df = spark.createDataFrame([("Alexandria",), ("Cairo",), ("Matruh",), ("Sharqia",)], "g STRING")
    assert values(df, partition_of("g")) == [0, 1, 2, None]
    with pytest.raises(PySparkException, match="Unknown governorate: Sharqia"):
        df.select(partition_of("g", strict=True)).collect()
    assert {len(m) for m in L.STREAM_PARTITIONS.values()} == {9}
    sites = {s[0] for s in L.SITES}
    assert sites == {g for members in L.STREAM_PARTITIONS.values() for g in members}


def test_stream_names_in_batch_spelling(spark):
    df = spark.createDataFrame([("Faiyum",), ("Matruh",), ("Kafr El Sheikh",)], "g STRING")
    assert values(df, batch_spelling("g")) == ["FAYOUM", "MATROUH", "KAFR EL SHEIKH"]


def test_surrogate_key(spark, ntz):
    df = ntz([("2021-01-01 00:00:00", "CAIRO"), ("2021-01-01 05:06:07.1239", None)],
             "datetime TIMESTAMP_NTZ, g STRING")
    assert values(df, timestamp_text("datetime")) == ["2021-01-01 00:00:00.000", "2021-01-01 05:06:07.123"]
    assert values(df, timestamp_text("datetime", millis=False))[0] == "2021-01-01 00:00:00"
    expected = [hashlib.md5(t.encode()).hexdigest() for t in (
        "2021-01-01 00:00:00.000-CAIRO", f"2021-01-01 05:06:07.123-{L.SURROGATE_NULL}")]
    assert values(df, surrogate_key(timestamp_text("datetime"), F.col("g"))) == expected


def test_keys_do_not_depend_on_the_session_zone(spark, ntz):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = ntz([("2021-03-28 02:30:00",)], "datetime TIMESTAMP_NTZ")  # falls into a clock change in Paris
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        assert values(df, timestamp_text("datetime")) == ["2021-03-28 02:30:00.000"]
        assert values(df, to_epoch(utc_instant("datetime"))) == [1616898600]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_time_from_parts(spark):
    df = spark.createDataFrame([(2006, 1, 2, 3), (2006, 13, 2, 5), (2006, 2, 29, 0), (2006, 1, 1, 24)],
                               "y INT, m INT, d INT, h INT")
    expected = [dt.datetime(2006, 1, 2, 3), None, None, None]
    assert values(df, from_parts("y", "m", "d", "h")) == expected
    assert values(df, from_parts_text("y", "m", "d", "h")) == expected


def test_epoch_and_latency(spark):
    df = spark.createDataFrame([(1761746585,)], "e BIGINT")
    assert values(df, utc_wall_clock(from_epoch("e"))) == [dt.datetime(2025, 10, 29, 14, 3, 5)]
    df = df.select(from_epoch("e").alias("a"), (from_epoch("e") + F.expr("INTERVAL '1.5' SECOND")).alias("b"))
    assert values(df, seconds_between("b", "a")) == [1.5]


def test_bucket_is_aligned_to_the_epoch(spark, ntz):
    df = ntz([("2024-01-01 05:59:59.9",)], "datetime TIMESTAMP_NTZ")
    assert values(df, bucket("datetime", "1 hour")) == [dt.datetime(2024, 1, 1, 5)]


def test_kelvin(spark):
    df = spark.createDataFrame([(301.48, 300.0)], "main_temp DOUBLE, other DOUBLE")
    assert in_celsius(df).first() == (28.33, 300.0)
    assert in_celsius(df, unit="celsius").first() == (301.48, 300.0)
    with pytest.raises(ValueError):
        in_celsius(df, unit="fahrenheit")


def test_dates(spark):
    df = spark.createDataFrame([(dt.date(1981, 1, 3),), (dt.date(2030, 12, 31),)], "d DATE")
    assert values(df, date_key("d")) == [19810103, 20301231]
    months = spark.range(1, 13).select(season(F.col("id")).alias("s"))
    assert [r.s for r in months.collect()] == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]
    assert values(spark.range(1), ts_literal("2024-01-01 00:00:00")) == [dt.datetime(2024, 1, 1)]

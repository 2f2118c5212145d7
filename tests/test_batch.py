import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from skygauge.operators.quality import GOLD_CHECKS, quality_report
from skygauge.plans import batch, gold
from skygauge.plans.silver import governorates, silver, silver_keys, standardize, unusable_rows
from skygauge.session import SHUFFLE_CONF, shuffles_for
from skygauge.schemas import BRONZE_COLUMNS, MEASURES, SOURCES, column_names
from skygauge.sources.changes import changed_after, note_changes
from skygauge.sources.csv_files import (bronze_path, count_files, files_to_copy, list_files, load_new_files, read_bronze,
                                        require_files)
from skygauge.sources.snapshots import versions
from skygauge.sources.tables import overwrite_table, read_table, upsert_table

RUN = "2025-01-01 00:00:00"
WEATHER_HEADER = "c1,c2,c3,c4,c5,c6,c7,c8,c9,c10,c11,c12,c13,c14,c15,c16"


def weather_line(city, date, t2m="20.5", rest="1"):
    return ",".join([city, date, t2m] + [rest] * 13)


def air_line(city, at, aqi="2"):
    return ",".join([city, at, aqi] + ["1"] * 8)


def solar_line(y, m, d, h, city, uv="3"):
    return ",".join([str(y), str(m), str(d), str(h)] + ["1"] * 8 + [uv, city])


def put(folder, name, header, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def test_csv_dialect_and_bad_rows(spark, tmp_path):
    put(tmp_path, "weather_a.csv", WEATHER_HEADER,
        weather_line('"Port, Said"', "2024-01-01"),
        weather_line("", "2024-01-02"),
        weather_line("Giza", "not a date"),
        weather_line("Giza", "2024-01-03", t2m="warm"),
        weather_line("Giza", "2024-01-04", t2m='""'),
        "Suez,2024-01-05,7.5",
        weather_line("Qena", "2024-01-06") + ",extra,fields",
        weather_line('"A ""quoted"", name\\"', "2024-01-07"))
    put(tmp_path, "other.csv", "x", "1")
    rows, rejected = read_bronze(spark, str(tmp_path), "weather", RUN)
    got = {r["date"].day: r for r in rows.collect()}
    assert sorted(got) == [1, 2, 4, 7]
    assert got[1]["city"] == "Port, Said" and got[2]["city"] is None
    assert got[4]["t2m"] is None                      # empty, quoted or not, is NULL
    assert got[7]["city"] == 'A "quoted", name\\'
    assert got[1]["load_timestamp"] == dt.datetime(2025, 1, 1)
    assert rows.columns == [*column_names(BRONZE_COLUMNS["weather"]), "load_timestamp"]
    assert sorted(r["bad_columns"] for r in rejected.collect()) == [["date"], ["field_count"], ["field_count"], ["t2m"]]
    assert rejected.filter(F.col("source_file").endswith("weather_a.csv")).count() == 4


def test_files_of_one_name_in_two_folders(spark, tmp_path):
    landing = tmp_path / "landing"
    for day, folder in ((1, "y2024"), (2, "y2025")):
        (landing / folder).mkdir(parents=True)
        put(landing / folder, "weather_a.csv", WEATHER_HEADER, weather_line("Giza", f"2024-01-0{day}"))
        for _ in range(2):  # the second run finds no new file
            load_new_files(spark, str(landing), str(tmp_path), "weather", RUN)
    rows = spark.read.parquet(bronze_path(str(tmp_path), "weather")).collect()
    assert sorted(r["date"].day for r in rows) == [1, 2]


def test_sentinel_becomes_null(spark, tmp_path):
    put(tmp_path, "solar_energy_a.csv", "h", solar_line(2024, 1, 1, 5, "Qena", uv="-999"))
    plain, _ = read_bronze(spark, str(tmp_path), "solar_energy", RUN)
    cleared, _ = read_bronze(spark, str(tmp_path), "solar_energy", RUN, null_sentinel=-999)
    assert plain.first()["allsky_sfc_uv_index"] == -999.0
    assert cleared.first()["allsky_sfc_uv_index"] is None


def test_each_file_is_loaded_once(spark, tmp_path):
    landing, house = tmp_path / "landing", str(tmp_path / "house")
    put(landing, "weather_1.csv", WEATHER_HEADER, weather_line("Giza", "2024-01-01"))
    for _ in range(2):
        load_new_files(spark, str(landing), house, "weather", RUN)
    assert batch.read_bronze_table(spark, house, "weather").count() == 1
    put(landing, "weather_2.csv", WEATHER_HEADER, weather_line("Giza", "2024-01-02"))
    load_new_files(spark, str(landing), house, "weather", "2025-01-02 00:00:00")
    loaded = batch.read_bronze_table(spark, house, "weather")
    assert sorted(r[0].day for r in loaded.select("load_timestamp").collect()) == [1, 2]


def test_a_backlog_is_loaded_in_steps(spark, tmp_path):
    landing, house = tmp_path / "landing", str(tmp_path / "house")
    for n in (1, 2, 3):
        put(landing, f"weather_{n}.csv", WEATHER_HEADER, weather_line("Giza", f"2024-01-0{n}"))
    load_new_files(spark, str(landing), house, "weather", RUN, bytes_per_batch="1")
    assert batch.read_bronze_table(spark, house, "weather").count() == 3
    assert len(list((tmp_path / "house" / "bronze" / "weather").glob("load_id=*"))) == 3


def test_shuffles_grow_with_the_input(spark):
    before = spark.conf.get(SHUFFLE_CONF)
    with shuffles_for(spark, 1 << 40):
        assert int(spark.conf.get(SHUFFLE_CONF)) == 8192
    with shuffles_for(spark, 10):
        assert spark.conf.get(SHUFFLE_CONF) == before
    assert spark.conf.get(SHUFFLE_CONF) == before


def test_file_listing(spark, tmp_path):
    put(tmp_path / "a", "air_pollution_weather.csv", "h")
    put(tmp_path / "a", "Solar_Energy_1.csv", "h")
    put(tmp_path / "a", "weather_1.csv", "h")
    put(tmp_path / "a", "notes.csv", "h")
    put(tmp_path / "a", "weather.txt", "h")
    put(tmp_path / "b", "weather_1.csv", "h")
    files = list_files(spark, str(tmp_path / "a"))
    assert {r["kind"]: r["files"] for r in count_files(files).collect()} == {
        "air_pollution": 1, "solar_energy": 1, "weather": 1, None: 1}
    landed = list_files(spark, str(tmp_path / "b"))
    assert "weather_1.csv" not in [r.file_name for r in files_to_copy(files, landed).collect()]
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        require_files(list_files(spark, str(tmp_path / "empty")))


def bronze_weather(spark, rows):
    """(city, day, t2m, load day) rows as bronze weather."""
    names = column_names(BRONZE_COLUMNS["weather"])[3:]
    df = spark.createDataFrame(rows, "city STRING, date DATE, t2m DOUBLE, load DATE")
    return df.select("city", "date", "t2m", *[F.lit(1.0).alias(n) for n in names],
                     F.col("load").cast("timestamp_ntz").alias("load_timestamp"))


def day(n, month=1, year=2024):
    return dt.date(year, month, n)


def test_two_cities_of_one_governorate(spark):
    rows = bronze_weather(spark, [("Siwah", day(1), 1.0, day(1)), ("Matrouh", day(1), 2.0, day(2)),
                                  ("Gulf of Suez", day(1), 3.0, day(1)), ("Giza", None, 4.0, day(1)),
                                  (None, day(1), 5.0, day(1))])
    result = silver(rows, "weather", RUN).collect()
    assert [(r["governorate"], r["temperature_2m_mean"]) for r in result] == [("MATROUH", 2.0)]
    assert unusable_rows(rows, "weather").count() == 3
    assert [tuple(r) for r in governorates(rows, "weather").collect()] == [("MATROUH",)]
    assert standardize(rows, "weather", RUN).columns == [
        "governorate", "date", *MEASURES["weather"].values(), "load_timestamp", "transform_timestamp"]
    assert silver_keys("weather") == ["date", "governorate"]


def test_silver_takes_only_newer_loads(spark):
    rows = bronze_weather(spark, [("Giza", day(1), 1.0, day(1)), ("Giza", day(2), 2.0, day(2))])
    stored = silver(rows.filter("t2m = 1"), "weather", RUN)
    assert [r["date"] for r in silver(rows, "weather", RUN, stored).collect()] == [day(2)]


def test_solar_time_is_made_of_parts(spark, tmp_path):
    put(tmp_path, "solar_energy_a.csv", "h", solar_line(2006, 1, 2, 5, "cairo"), solar_line(2006, 13, 2, 5, "cairo"))
    rows, _ = read_bronze(spark, str(tmp_path), "solar_energy", RUN)
    assert [r["datetime"] for r in silver(rows, "solar_energy", RUN).collect()] == [dt.datetime(2006, 1, 2, 5)]
    assert unusable_rows(rows, "solar_energy").count() == 1


def test_dim_date(spark):
    dates = gold.dim_date(spark, RUN)
    assert dates.count() == 18262 and len(dates.columns) == 13
    got = {r["date_value"]: r for r in dates.filter("date_key IN (19810102, 19810103, 20301231, 20240229)").collect()}
    saturday = got[day(3, 1, 1981)]
    assert (saturday["day_of_week"], saturday["day_name"], saturday["is_weekend"]) == (6, "Sat", True)
    assert got[day(2, 1, 1981)]["is_weekend"] is False
    assert got[day(29, 2)]["month_name"] == "Feb" and got[day(29, 2)]["season"] == "Winter"
    assert got[day(31, 12, 2030)]["week_of_year"] == 1
    friday = gold.dim_date(spark, RUN, weekend_days=(5, 6)).filter("date_key = 19810102").first()
    assert friday["is_weekend"] is True


def test_governorate_keys_stay_on_refresh(spark):
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "governorate STRING")
    first = gold.dim_governorate([names("GIZA", "ASWAN", None), names("GIZA")], RUN)
    again = gold.dim_governorate([names("BEHEIRA", "GIZA", "CAIRO")], "2026-01-01 00:00:00", stored=first)
    got = {r["governorate_name"]: (r["governorate_key"], r["region"]) for r in again.collect()}
    assert got == {"ASWAN": (1, "Upper Egypt"), "GIZA": (2, "Greater Cairo"),
                   "BEHEIRA": (3, "Alexandria and North Coast"), "CAIRO": (4, "Greater Cairo")}


def test_fact_edges(spark):
    rows = silver(bronze_weather(spark, [("Giza", day(1), 10.0, day(1)), ("Giza", day(1, 1, 2031), 30.0, day(1)),
                                         ("Luxor", day(1), 1.0, day(1))]), "weather", RUN)
    places = gold.dim_governorate([rows.filter("governorate = 'GIZA'")], RUN)
    fact = gold.fact_weather(rows, places, gold.dim_date(spark, RUN), RUN)
    got = {r["date"]: r for r in fact.collect()}
    assert set(got) == {day(1), day(1, 1, 2031)}              # LUXOR has no key
    assert got[day(1)]["temperature_category"] == "Mild" and got[day(1)]["date_key"] == 20240101
    assert got[day(1)]["weather_key"] == hashlib.md5(b"2024-01-01-GIZA").hexdigest()
    assert got[day(1, 1, 2031)]["date_key"] is None


def write_landing(landing, suffix, city="Giza", date="2024-01-01"):
    put(landing, f"weather_{suffix}.csv", WEATHER_HEADER, weather_line(city, date))
    put(landing, f"air_pollution_{suffix}.csv", "h", air_line(city, f"{date} 05:00:00"))
    put(landing, f"solar_energy_{suffix}.csv", "h", solar_line(*map(int, date.split("-")), 7, city))


def test_whole_batch_run(spark, tmp_path):
    landing, house = tmp_path / "landing", str(tmp_path / "house")
    write_landing(landing, "1")
    report = batch.run_batch(spark, str(landing), house, RUN)
    counts = report.groupBy("check").count().collect()
    assert {r["check"]: r["count"] for r in counts} == {"unique": 7, "not_null": 19, "relationships": 6}
    assert report.filter("failures > 0").count() == 0
    assert {r["table_name"]: r["row_count"] for r in batch.bronze_counts(spark, house).collect()} == dict.fromkeys(SOURCES, 1)

    # A new governorate has no key until the dimension is refreshed, and then needs a repair.
    write_landing(landing, "2", city="Luxor", date="2024-01-02")
    batch.run_batch(spark, str(landing), house, "2025-02-01 00:00:00")
    facts = lambda: read_table(spark, batch.gold_path(house, "fact_weather")).count()
    assert facts() == 1
    batch.run_batch(spark, str(landing), house, "2025-03-01 00:00:00", refresh_dimensions=True)
    assert facts() == 2  # nothing of a later run had landed, so the mark still lets the row in
    write_landing(landing, "3", city="Qena", date="2024-01-03")
    write_landing(landing, "4", city="Giza", date="2024-01-04")
    batch.run_batch(spark, str(landing), house, "2025-04-01 00:00:00")
    assert facts() == 3
    batch.run_batch(spark, str(landing), house, "2025-05-01 00:00:00", refresh_dimensions=True)
    assert facts() == 3  # passed over by the mark
    batch.run_batch(spark, str(landing), house, "2025-06-01 00:00:00", repair_facts=True)
    assert facts() == 4


def test_failures_are_stored(spark, tmp_path):
    landing, house = tmp_path / "landing", str(tmp_path / "house")
    write_landing(landing, "1", date="2031-01-01")            # beyond the date dimension
    report = batch.run_batch(spark, str(landing), house, RUN)
    failed = {(r["check"], r["table"], r["column"]) for r in report.filter("failures > 0").collect()}
    assert failed == {("not_null", f"fact_{s}", "date_key") for s in SOURCES}
    assert spark.read.parquet(f"{house}/audit/not_null_fact_weather_date_key").count() == 1


def test_report_counts(spark):
    tables = {
        "dim_governorate": spark.createDataFrame([(1, "A", "R"), (1, "B", None), (2, "A", "R")],
                                                 "governorate_key INT, governorate_name STRING, region STRING"),
        "dim_date": spark.createDataFrame([(1, dt.date(2024, 1, 1), 2024, "Winter")],
                                          "date_key INT, date_value DATE, year INT, season STRING"),
        "fact_weather": spark.createDataFrame(
            [("k", 1, 1, dt.date(2024, 1, 1)), ("k", 9, None, None), (None, 9, 7, None)],
            "weather_key STRING, governorate_key INT, date_key INT, date DATE"),
    }
    report = quality_report(tables, {n: GOLD_CHECKS[n] for n in tables})
    got = {(r["check"], r["table"], r["column"]): r["failures"] for r in report.collect() if r["failures"]}
    assert got == {
        ("unique", "dim_governorate", "governorate_key"): 1, ("unique", "dim_governorate", "governorate_name"): 1,
        ("not_null", "dim_governorate", "region"): 1, ("unique", "fact_weather", "weather_key"): 1,
        ("not_null", "fact_weather", "weather_key"): 1, ("not_null", "fact_weather", "date_key"): 1,
        ("not_null", "fact_weather", "date"): 2,
        ("relationships", "fact_weather", "governorate_key"): 2, ("relationships", "fact_weather", "date_key"): 1}


def test_a_run_opens_new_loads_only(spark, tmp_path):
    landing, house = tmp_path / "landing", str(tmp_path / "house")
    write_landing(landing, "1")
    batch.load_bronze(spark, str(landing), house, RUN)
    assert batch.taken_load(spark, house, "weather") is None
    batch.build_silver(spark, house, RUN)
    first = batch.taken_load(spark, house, "weather")
    assert first == batch.loads(spark, house, "weather")[-1]
    batch.build_silver(spark, house, RUN)                     # nothing new
    write_landing(landing, "2", date="2024-01-02")
    batch.load_bronze(spark, str(landing), house, "2025-02-01 00:00:00")
    fresh = batch.read_bronze_table(spark, house, "weather", first)
    assert [r["date"] for r in fresh.collect()] == [day(2)]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_id" in plan and f"> {first})]" in plan
    batch.build_silver(spark, house, "2025-02-01 00:00:00")
    rows = read_table(spark, batch.silver_path(house, "weather")).collect()
    assert sorted((r["date"], r["transform_timestamp"].month) for r in rows) == [(day(1), 1), (day(2), 2)]


def test_report_scans_a_fact_twice(spark, tmp_path):
    columns = {"dim_governorate": "governorate_key INT, governorate_name STRING, region STRING",
               "dim_date": "date_key INT, date_value DATE, year INT, season STRING",
               "fact_weather": "weather_key STRING, governorate_key INT, date_key INT, date DATE"}
    tables = {}
    for name, ddl in columns.items():
        spark.createDataFrame([], ddl).write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    report = quality_report(tables, {"fact_weather": GOLD_CHECKS["fact_weather"]})
    plan = report._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 4 and sum("weather_key" in line for line in scans) == 2  # and one of each parent
    assert {r["failures"] for r in report.collect()} == {0} and report.count() == 7


def break_files(folder):
    """Make the files of a period unreadable; returns how many."""
    files = [f for f in folder.rglob("*.parquet")]
    for f in files:
        f.write_bytes(b"not to be read")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    return len(files)


def test_a_second_run_opens_changed_periods_only(spark, tmp_path):
    landing, house = tmp_path / "landing", str(tmp_path / "house")
    write_landing(landing, "1")
    write_landing(landing, "2", date="2024-02-10")
    batch.run_batch(spark, str(landing), house, RUN)
    for layer in ("silver/weather", "gold/fact_weather"):
        assert break_files(tmp_path / "house" / layer / "period=2024-01-01")
    write_landing(landing, "3", city="Giza", date="2024-02-20")
    report = batch.run_batch(spark, str(landing), house, "2025-02-01 00:00:00")   # January is neither read nor checked again
    assert report.filter("failures > 0").count() == 0 and report.count() == 32
    assert changed_after(spark, batch.silver_path(house, "weather"), 0) == [day(1).replace(month=2)]
    fact = read_table(spark, batch.gold_path(house, "fact_weather")).filter("period = '2024-02-01'")
    assert sorted(r["date"].day for r in fact.collect()) == [10, 20]
    before = versions(spark, f"{house}/audit/by_period/fact_weather")
    batch.run_batch(spark, str(landing), house, "2025-03-01 00:00:00")            # nothing new: nothing is checked
    assert versions(spark, f"{house}/audit/by_period/fact_weather") == before


def test_merged_report_follows_mended_periods(spark, tmp_path):
    landing, house = tmp_path / "landing", str(tmp_path / "house")
    write_landing(landing, "1")
    batch.run_batch(spark, str(landing), house, RUN)
    fact = batch.gold_path(house, "fact_weather")
    rows = read_table(spark, fact)
    bad = rows.withColumns({"weather_key": F.lit("x"), "governorate_key": F.lit(99).cast("bigint"), "date_key": F.lit(None).cast("int"),
                            "date": F.lit("2024-03-05").cast("date")}).drop("period")
    note_changes(spark, fact, upsert_table(bad, fact, ["weather_key"], ["load_timestamp"], "date"))
    failures = lambda **k: {(r["check"], r["column"]): r["failures"] for r in batch.check_gold(spark, house, **k).filter(
        "failures > 0").collect()}
    wanted = {("not_null", "date_key"): 1, ("relationships", "governorate_key"): 1}
    assert failures() == wanted and failures() == wanted and failures(everything=True) == wanted
    orphans = spark.read.parquet(f"{house}/audit/relationships_fact_weather_governorate_key")
    assert [r["governorate_key"] for r in orphans.collect()] == [99]
    places = read_table(spark, batch.gold_path(house, "dim_governorate"))
    key = places.filter("governorate_name is not null").limit(1).withColumns(
        {"governorate_key": F.lit(99).cast(dict(places.dtypes)["governorate_key"]), "governorate_name": F.lit("NEW")})
    overwrite_table(places.unionByName(key).checkpoint(), batch.gold_path(house, "dim_governorate"))
    assert failures() == {("not_null", "date_key"): 1}    # the dimension has got the key since

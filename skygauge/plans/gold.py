"""Silver to gold: the date and governorate dimensions and the three facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skygauge import lookups as L
from skygauge.functions.bands import classify, region_class, season
from skygauge.functions.keys import date_key, surrogate_key, timestamp_text
from skygauge.functions.times import hour_of_day, ts_literal
from skygauge.operators.keyed import missed_rows, newer_than
from skygauge.operators.sizing import number_rows
from skygauge.schemas import MEASURES, TIME_COLUMN

FACT_KEYS = {"air_pollution": "air_pollution_key", "solar_energy": "solar_energy_key",
             "weather": "weather_key"}


def dim_date(spark: SparkSession, run_ts, start: str = L.DIM_DATE_START, end: str = L.DIM_DATE_END,
             weekend_days: Sequence[int] = L.WEEKEND_DAYS) -> DataFrame:
    """One row per day of the span, both ends included.

    Days of the week count from Sunday = 0. The default weekend is {6, 7}, of which only 6 occurs.
    """
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date_value"))
    day, month = F.col("date_value"), F.month("date_value")
    weekday = F.dayofweek(day) - 1
    return days.select(
        date_key(day).alias("date_key"), "date_value", F.year(day).alias("year"),
        F.quarter(day).alias("quarter"), month.alias("month"), F.monthname(day).alias("month_name"),
        F.dayofmonth(day).alias("day"), weekday.alias("day_of_week"), F.dayname(day).alias("day_name"),
        F.weekofyear(day).alias("week_of_year"), weekday.isin(*weekend_days).alias("is_weekend"),
        season(month).alias("season"), ts_literal(run_ts).alias("created_at"))


def governorate_names(silver_tables: Sequence[DataFrame]) -> DataFrame:
    """Distinct governorate names of the silver tables; each task reduces its rows first."""
    names = reduce(DataFrame.unionByName, [t.select("governorate") for t in silver_tables])
    return names.distinct().dropna().withColumnRenamed("governorate", "governorate_name")


def _describe(numbered: DataFrame, run_ts) -> DataFrame:
    return numbered.select("governorate_key", "governorate_name",
                           region_class("governorate_name").alias("region"),
                           ts_literal(run_ts).alias("created_at"), ts_literal(run_ts).alias("updated_at"))


def dim_governorate(silver_tables: Sequence[DataFrame], run_ts, stored: DataFrame | None = None) -> DataFrame:
    """Numbered governorate names with their region class.

    With a ``stored`` dimension its keys stay, since facts refer to them, and only new names are
    numbered, after the greatest key in use.
    """
    names = governorate_names(silver_tables)
    if stored is None:
        return _describe(number_rows(names, ["governorate_name"], "governorate_key"), run_ts)
    new = names.join(stored.select("governorate_name"), "governorate_name", "left_anti")
    last = stored.agg(F.coalesce(F.max("governorate_key"), F.lit(0))).first()[0]
    added = number_rows(new, ["governorate_name"], "governorate_key", start=last + 1)
    return stored.unionByName(_describe(added, run_ts))


def _categories(source: str) -> list[Column]:
    if source == "weather":
        return [classify("temperature_2m_mean", L.TEMPERATURE_RULES).alias("temperature_category"),
                classify("relative_humidity_2m", L.HUMIDITY_RULES).alias("humidity_category"),
                classify("precipitation_corrected", L.PRECIPITATION_RULES).alias("precipitation_category")]
    if source == "air_pollution":
        return [classify("air_quality_index", L.AIR_QUALITY_RULES).alias("air_quality_category")]
    return [classify("all_sky_surface_uv_index", L.UV_INDEX_RULES).alias("uv_index_category")]


def fact(silver: DataFrame, dim_governorate: DataFrame, dim_date: DataFrame, source: str, run_ts,
         stored: DataFrame | None = None) -> DataFrame:
    """Fact rows of a silver table: all, or those above the stored high-water mark.

    Rows whose governorate has no key are dropped; rows whose day is not in the date dimension stay
    with a NULL date key, which the not-null check reports.
    """
    time = TIME_COLUMN[source]
    fresh = newer_than(silver, stored, "transform_timestamp")
    places = dim_governorate.select("governorate_key", F.col("governorate_name").alias("governorate"))
    days = dim_date.select("date_key", F.col("date_value").alias("_day"))
    # the date dimension has one row per day of the calendar; the size of the other one is left to the planner
    joined = (fresh.join(places, "governorate").withColumn("_day", F.to_date(time))
              .join(F.broadcast(days), "_day", "left"))
    time_text = F.col(time).cast("string") if time == "date" else timestamp_text(time)
    hours = [] if time == "date" else [hour_of_day(time).alias("hour_of_day")]
    return joined.select(
        surrogate_key(time_text, F.col("governorate")).alias(FACT_KEYS[source]),
        "governorate_key", "date_key", time, *hours, *MEASURES[source].values(),
        *_categories(source), "load_timestamp", "transform_timestamp",
        ts_literal(run_ts).alias("created_at"))


def fact_weather(silver, dim_governorate, dim_date, run_ts, stored=None) -> DataFrame:
    return fact(silver, dim_governorate, dim_date, "weather", run_ts, stored)


def fact_air_pollution(silver, dim_governorate, dim_date, run_ts, stored=None) -> DataFrame:
    return fact(silver, dim_governorate, dim_date, "air_pollution", run_ts, stored)


def fact_solar_energy(silver, dim_governorate, dim_date, run_ts, stored=None) -> DataFrame:
    return fact(silver, dim_governorate, dim_date, "solar_energy", run_ts, stored)


def repaired(silver, dim_governorate, dim_date, source: str, run_ts, stored: DataFrame) -> DataFrame:
    """Fact rows the high-water mark passed over, such as those whose governorate came later."""
    everything = fact(silver, dim_governorate, dim_date, source, run_ts)
    return missed_rows(everything, stored, [FACT_KEYS[source]])

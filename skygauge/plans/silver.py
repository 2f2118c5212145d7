"""Bronze to silver: stored names, business names of the measures, one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skygauge.functions.names import canonical_name, is_dropped
from skygauge.functions.times import from_parts, ts_literal
from skygauge.operators.keyed import latest_per_key, newer_than
from skygauge.schemas import MEASURES, TIME_COLUMN


def _time(source: str) -> Column:
    if source == "solar_energy":
        return from_parts("year", "mo", "dy", "hr").alias("datetime")
    return F.col(TIME_COLUMN[source])


def silver_keys(source: str) -> list[str]:
    """Key of a silver table. The time comes first: it decides most comparisons of a sort by key."""
    return [TIME_COLUMN[source], "governorate"]


def _usable(source: str) -> Column:
    """Rows that get a governorate and a time; as plain tests of raw columns where possible."""
    raw_time = "year" if source == "solar_energy" else TIME_COLUMN[source]
    return (F.col("city").isNotNull() & F.col(raw_time).isNotNull() & ~is_dropped("city", source)
            & _time(source).isNotNull())


def standardize(bronze: DataFrame, source: str, run_ts) -> DataFrame:
    """Rows with stored names and measures; rows without governorate or time are dropped."""
    return (bronze.filter(_usable(source))
            .select(canonical_name("city", source).alias("governorate"), _time(source),
                    *[F.col(raw).alias(name) for raw, name in MEASURES[source].items()],
                    "load_timestamp")
            .withColumn("transform_timestamp", ts_literal(run_ts)))


def unusable_rows(bronze: DataFrame, source: str) -> DataFrame:
    """Bronze rows that ``standardize`` drops, for the count of rejects."""
    return bronze.filter(~F.coalesce(_usable(source), F.lit(False)))


def governorates(bronze: DataFrame, source: str) -> DataFrame:
    """Distinct stored names of the usable rows, without building silver.

    Raw names are reduced first, so the renaming runs once per spelling instead of once per row.
    """
    spellings = bronze.filter(F.col("city").isNotNull() & _time(source).isNotNull()).select("city").distinct()
    return spellings.select(canonical_name("city", source).alias("governorate")).dropna().distinct()


def silver(bronze: DataFrame, source: str, run_ts, stored: DataFrame | None = None) -> DataFrame:
    """New silver rows of a source, one per key: all, or those above the stored high-water mark."""
    fresh = newer_than(bronze, stored, "load_timestamp")
    return latest_per_key(standardize(fresh, source, run_ts), silver_keys(source), ["load_timestamp"])


def silver_weather(bronze: DataFrame, run_ts, stored: DataFrame | None = None) -> DataFrame:
    return silver(bronze, "weather", run_ts, stored)


def silver_air_pollution(bronze: DataFrame, run_ts, stored: DataFrame | None = None) -> DataFrame:
    return silver(bronze, "air_pollution", run_ts, stored)


def silver_solar_energy(bronze: DataFrame, run_ts, stored: DataFrame | None = None) -> DataFrame:
    return silver(bronze, "solar_energy", run_ts, stored)

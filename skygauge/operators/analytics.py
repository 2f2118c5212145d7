"""Analyses over the gold tables: change, season, region, trend and site ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from skygauge.operators.sizing import percent_rank
from skygauge.session import shared_dir


def with_dimensions(fact: DataFrame, dim_governorate: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact rows with the attributes of both dimensions."""
    places = dim_governorate.select("governorate_key", "governorate_name", "region")
    days = dim_date.select("date_key", "year", "quarter", "month", "season")
    return fact.join(places, "governorate_key").join(F.broadcast(days), "date_key")  # a row per day of the calendar


def year_over_year(facts: DataFrame, measure: str) -> DataFrame:
    """Yearly mean per governorate with its change to the year before."""
    yearly = facts.groupBy("governorate_name", "year").agg(F.avg(measure).alias("mean"))
    # At most one row per year in a group.
    before = F.lag("mean").over(Window.partitionBy("governorate_name").orderBy("year"))
    return (yearly.withColumn("previous", before)
            .withColumn("change", F.col("mean") - F.col("previous"))
            .withColumn("change_pct", 100 * F.col("change") / F.nullif("previous", F.lit(0.0))))


def season_summary(facts: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Count and means per region class, year and season."""
    return facts.groupBy("region", "year", "season").agg(
        F.count("*").alias("n"), *[F.avg(c).alias(name) for c, name in measures.items()])


def region_compare(facts: DataFrame, measure: str) -> DataFrame:
    """Yearly mean, minimum and maximum per region class, ranked within the year."""
    yearly = facts.groupBy("region", "year").agg(
        F.avg(measure).alias("mean"), F.min(measure).alias("min"), F.max(measure).alias("max"),
        F.count("*").alias("n"))
    # A year holds one row per region class, six at most.
    place = F.rank().over(Window.partitionBy("year").orderBy(F.desc("mean"), "region"))
    return yearly.withColumn("place", place.cast("bigint"))


def trend(facts: DataFrame, measure: str) -> DataFrame:
    """Least-squares slope per year of the yearly means."""
    yearly = facts.groupBy("governorate_name", "year").agg(F.avg(measure).alias("mean"))
    return yearly.groupBy("governorate_name").agg(
        F.regr_slope("mean", F.col("year").cast("double")).alias("slope"),
        F.count("*").alias("years"))


def site_ranking(solar: DataFrame, top: int) -> DataFrame:
    """Sites by solar potential: of irradiance, clear-sky ratio and variability the percent ranks over all sites are
    weighted, the last one counting against a site.

    The row per site is checkpointed, so the facts are read once for the three ranks.
    """
    shared_dir(solar.sparkSession)
    got, clear = F.col("all_sky_surface_shortwave_downward"), F.col("clear_sky_surface_shortwave_downward")
    sites = (solar.groupBy("governorate_name")
             .agg(F.count("*").alias("hours"), F.avg(got).alias("irradiance"),
                  (F.sum(got) / F.nullif(F.sum(clear), F.lit(0.0))).alias("clear_ratio"),
                  (F.stddev_samp(got) / F.nullif(F.avg(got), F.lit(0.0))).alias("variability"))
             .checkpoint())
    ranked = sites
    for column in ("irradiance", "clear_ratio", "variability"):
        ranked = percent_rank(ranked, column, f"_{column}")
    score = 0.5 * F.col("_irradiance") + 0.3 * F.col("_clear_ratio") + 0.2 * (1 - F.col("_variability"))
    return (ranked.select(*sites.columns, score.alias("score"))
            .orderBy(F.desc(F.round("score", 6)), "governorate_name").limit(top))


def region_overview(facts: DataFrame, measures: dict[str, str], first_year: int, last_year: int) -> DataFrame:
    """Count and means per region class and month of a span of years."""
    return (facts.filter(F.col("year").between(first_year, last_year))
            .groupBy("region", "year", "month")
            .agg(F.count("*").alias("n"), *[F.avg(c).alias(name) for c, name in measures.items()]))

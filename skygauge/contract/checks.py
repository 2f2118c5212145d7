"""Queries of the data-quality checks and of the analyses over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge.contract import sqltext as S
from skygauge.contract.layers import names_of, places_table
from skygauge.contract.registry import query
from skygauge.contract.standins import RUN_TS, bronze, load
from skygauge.contract.dashboards import rounded
from skygauge.operators import analytics, quality
from skygauge.plans import gold
from skygauge.plans.silver import silver
from skygauge.schemas import SOURCES
from skygauge.session import scratch_path

_HOUR = "CAST(o_orderkey % 26 AS INT)"


@query(f"SELECT o_orderkey, {_HOUR} AS hour FROM orders WHERE {_HOUR} > 23")
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose time cannot be made of its parts."""
    hour = (F.col("o_orderkey") % 26).cast("int")
    made = F.try_make_timestamp_ntz(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"),
                                    hour, F.lit(0), F.lit(0))
    rows = load(spark, sf_dir, "orders").select("o_orderkey", hour.alias("hour"), made.alias("at"))
    return quality.null_rows(rows, "at").drop("at")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without line items."""
    return quality.orphan_rows(load(spark, sf_dir, "orders"), "o_orderkey",
                               load(spark, sf_dir, "lineitem"), "l_orderkey")


@query("""SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN
    (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1""")
def dq_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of line items that are not in good standing, with the number of their items."""
    good = load(spark, sf_dir, "supplier").filter("s_acctbal > 0")
    return quality.orphan_keys(load(spark, sf_dir, "lineitem"), "l_suppkey", good, "s_suppkey")


def report_sql() -> str:
    parts = []
    for table, checks in quality.GOLD_CHECKS.items():
        for c in checks.not_null:
            parts.append(f"SELECT 'not_null' AS \"check\", '{table}' AS \"table\", '{c}' AS \"column\", "
                         f"count(*) AS failures FROM {table} WHERE {c} IS NULL")
        for c in checks.unique:
            parts.append(f"SELECT 'unique', '{table}', '{c}', count(*) FROM (SELECT {c} FROM {table} "
                         f"WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        for c, parent, field in checks.relationships:
            parts.append(f"SELECT 'relationships', '{table}', '{c}', count(*) FROM {table} WHERE {c} IS NOT NULL "
                         f"AND {c} NOT IN (SELECT {field} FROM {parent})")
    return f"WITH {S.gold_cte(*SOURCES)} " + " UNION ALL ".join(parts)


@query(report_sql())
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks over stored gold tables, so that each fact is computed once for its checks."""
    place = scratch_path(spark, "gold")
    rows = {s: silver(bronze(spark, sf_dir, s), s, RUN_TS) for s in SOURCES}
    gold.dim_date(spark, RUN_TS).write.parquet(f"{place}/dim_date")
    gold.dim_governorate(names_of(spark, sf_dir, *SOURCES), RUN_TS).write.parquet(f"{place}/dim_governorate")
    tables = {n: spark.read.parquet(f"{place}/{n}") for n in ("dim_date", "dim_governorate")}
    for s in SOURCES:
        fact = gold.fact(rows[s], tables["dim_governorate"], tables["dim_date"], s, RUN_TS)
        fact.write.parquet(f"{place}/fact_{s}")
        tables[f"fact_{s}"] = spark.read.parquet(f"{place}/fact_{s}")
    return quality.quality_report(tables)


_SHORT = "1995-12-31"


@query(f"WITH {S.gold_cte('weather').replace('2030-12-31', _SHORT)} "
       "SELECT weather_key, governorate_key, date FROM fact_weather WHERE date_key IS NULL")
def dq_stored_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts beyond a date dimension that ends early, as the failed check has stored them."""
    place = scratch_path(spark, "failures")
    days = gold.dim_date(spark, RUN_TS, end=_SHORT)
    places = places_table(spark, sf_dir)
    rows = silver(bronze(spark, sf_dir, "weather"), "weather", RUN_TS)
    gold.fact(rows, places, days, "weather", RUN_TS).write.parquet(f"{place}/fact_weather")
    tables = {"dim_governorate": places, "dim_date": days, "fact_weather": spark.read.parquet(f"{place}/fact_weather")}
    checks = {"fact_weather": quality.GOLD_CHECKS["fact_weather"]}
    quality.store_failures(tables, quality.quality_report(tables, checks), f"{place}/audit")
    return spark.read.parquet(f"{place}/audit/not_null_fact_weather_date_key").select("weather_key", "governorate_key", "date")


_SITE = "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS name, c_nationkey - 3.0E0 AS lat, c_custkey % 4 - 1.0E0 AS lon"


@query(f"SELECT * FROM (SELECT {_SITE} FROM customer) WHERE name IS NOT NULL AND name <> '' AND lat <> 0 AND lon <> 0")
def site_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as sites, of which those without a name or a coordinate are left out."""
    return quality.complete_sites(load(spark, sf_dir, "customer").selectExpr(*_SITE.split(", ")))


# --- analyses --------------------------------------------------------------------------------

def _facts(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    places = places_table(spark, sf_dir)
    days = gold.dim_date(spark, RUN_TS)
    rows = silver(bronze(spark, sf_dir, source), source, RUN_TS)
    return analytics.with_dimensions(gold.fact(rows, places, days, source, RUN_TS), places, days)


def _with_facts(source: str, select: str) -> str:
    return (f"WITH {S.gold_cte(source)}, facts AS (SELECT f.*, g.governorate_name, g.region, t.year, t.quarter, "
            f"t.month, t.season FROM fact_{source} f JOIN dim_governorate g USING (governorate_key) "
            f"JOIN dim_date t USING (date_key)){select}")


_YEARLY = "(SELECT governorate_name, year, avg(temperature_2m_mean) AS m FROM facts GROUP BY 1, 2)"


@query(_with_facts("weather", f""" SELECT governorate_name, year, round(m, 9) AS mean, round(previous, 9) AS previous,
    round(m - previous, 6) AS change, round(100 * (m - previous) / previous, 6) AS change_pct
    FROM (SELECT *, lag(m) OVER (PARTITION BY governorate_name ORDER BY year) AS previous FROM {_YEARLY})"""))
def yoy_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = analytics.year_over_year(_facts(spark, sf_dir, "weather"), "temperature_2m_mean")
    return rounded(rounded(result, 9, "mean", "previous"), 6, "change", "change_pct")


@query(_with_facts("weather", """ SELECT region, year, season, count(*) AS n,
    round(avg(temperature_2m_mean), 9) AS temperature, round(avg(precipitation_corrected), 9) AS precipitation
    FROM facts GROUP BY 1, 2, 3"""))
def season_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = analytics.season_summary(_facts(spark, sf_dir, "weather"), {
        "temperature_2m_mean": "temperature", "precipitation_corrected": "precipitation"})
    return rounded(result, 9, "temperature", "precipitation")


@query(_with_facts("weather", """ SELECT region, year, round(m, 9) AS mean, lo AS min, hi AS max, n,
    rank() OVER (PARTITION BY year ORDER BY m DESC) AS place
    FROM (SELECT region, year, avg(temperature_2m_mean) AS m, min(temperature_2m_mean) AS lo,
                 max(temperature_2m_mean) AS hi, count(*) AS n FROM facts GROUP BY 1, 2)"""))
def region_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analytics.region_compare(_facts(spark, sf_dir, "weather"), "temperature_2m_mean"), 9, "mean")


@query(_with_facts("weather", f""" SELECT governorate_name, round(regr_slope(m, year), 6) AS slope, count(*) AS years
    FROM {_YEARLY} GROUP BY 1"""))
def trend_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analytics.trend(_facts(spark, sf_dir, "weather"), "temperature_2m_mean"), 6, "slope")


@query(_with_facts("solar_energy", """, sites AS (SELECT governorate_name, count(*) AS hours,
        avg(all_sky_surface_shortwave_downward) AS irradiance,
        sum(all_sky_surface_shortwave_downward) / sum(clear_sky_surface_shortwave_downward) AS clear_ratio,
        stddev_samp(all_sky_surface_shortwave_downward) / avg(all_sky_surface_shortwave_downward) AS variability
        FROM facts GROUP BY 1),
    ranked AS (SELECT *, percent_rank() OVER (ORDER BY irradiance NULLS FIRST) AS ri,
        percent_rank() OVER (ORDER BY clear_ratio NULLS FIRST) AS rc, percent_rank() OVER (ORDER BY variability NULLS FIRST) AS rv
        FROM sites)
    SELECT governorate_name, hours, round(irradiance, 6) AS irradiance, round(clear_ratio, 6) AS clear_ratio,
        round(variability, 6) AS variability, round(0.5E0 * ri + 0.3E0 * rc + 0.2E0 * (1 - rv), 6) AS score
    FROM ranked ORDER BY score DESC, 1 LIMIT 5"""))
def site_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best sites."""
    sites = analytics.site_ranking(_facts(spark, sf_dir, "solar_energy"), top=5)
    return rounded(sites, 6, "irradiance", "clear_ratio", "variability", "score")


@query(_with_facts("air_pollution", """ SELECT region, year, month, count(*) AS n,
    round(avg(air_quality_index), 9) AS air_quality_index, round(avg(ozone), 9) AS ozone
    FROM facts WHERE year BETWEEN 1996 AND 1999 GROUP BY 1, 2, 3"""))
def region_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = analytics.region_overview(
        _facts(spark, sf_dir, "air_pollution"),
        {"air_quality_index": "air_quality_index", "ozone": "ozone"}, 1996, 1999)
    return rounded(result, 9, "air_quality_index", "ozone")

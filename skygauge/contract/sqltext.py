"""Pieces of DuckDB SQL that several checks share."""

from __future__ import annotations

from skygauge import lookups as L
from skygauge.contract.standins import RUN_TS, bronze_sql, readings_sql
from skygauge.plans.gold import FACT_KEYS
from skygauge.schemas import MEASURES, SOURCES, TIME_COLUMN

RUN = f"TIMESTAMP '{RUN_TS}'"


def text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def case_rules(column: str, rules, default: str | None = L.UNKNOWN) -> str:
    branches = " ".join(f"WHEN {column} {op} {bound} THEN {text(name)}" for name, op, bound in rules)
    return f"CASE {branches} ELSE {text(default)} END"


def region_case(column: str) -> str:
    branches = " ".join(f"WHEN {column} IN ({', '.join(map(text, names))}) THEN {text(region)}"
                        for region, names in L.REGION_CLASSES.items())
    return f"CASE {branches} ELSE {text(L.OTHER_REGION)} END"


def name_case(column: str, source: str) -> str:
    clean = f"upper(trim({column}))"
    branches = " ".join(f"WHEN {text(raw)} THEN {text(to)}" for raw, to in L.CITY_ALIASES[source].items())
    return f"CASE {clean} {branches} ELSE {clean} END"


def newest_first(columns) -> str:
    return ", ".join(f'"{c}" DESC NULLS LAST' for c in columns)


def standardized_cte(source: str) -> str:
    """CTEs ``bronze_x`` and ``std_x``."""
    time = ("CASE WHEN hr < 24 THEN make_timestamp(year, mo, dy, hr, 0, 0) END AS datetime"
            if source == "solar_energy" else TIME_COLUMN[source])
    key = TIME_COLUMN[source]
    measures = ", ".join(f'"{raw}" AS {name}' for raw, name in MEASURES[source].items())
    return (f"bronze_{source} AS ({bronze_sql(source)}), "
            f"std_{source} AS (SELECT * FROM (SELECT {name_case('city', source)} AS governorate, {time}, "
            f"{measures}, load_timestamp FROM bronze_{source}) "
            f"WHERE governorate IS NOT NULL AND {key} IS NOT NULL)")


def silver_cte(source: str) -> str:
    """CTEs up to ``silver_x``."""
    key = TIME_COLUMN[source]
    order = newest_first(["load_timestamp", *MEASURES[source].values()])
    return (f"{standardized_cte(source)}, "
            f"silver_{source} AS (SELECT * EXCLUDE (rn), {RUN} AS transform_timestamp FROM (SELECT *, "
            f"row_number() OVER (PARTITION BY governorate, {key} ORDER BY {order}) AS rn "
            f"FROM std_{source}) WHERE rn = 1)")


DIM_DATE = f"""
    dim_date AS (
        SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS date_value,
               CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
               CAST(month(d) AS INT) AS month, strftime(d, '%b') AS month_name,
               CAST(day(d) AS INT) AS day, CAST(dayofweek(d) AS INT) AS day_of_week,
               strftime(d, '%a') AS day_name, CAST(weekofyear(d) AS INT) AS week_of_year,
               dayofweek(d) = 6 AS is_weekend,
               CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) <= 5 THEN 'Spring'
                    WHEN month(d) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season,
               {RUN} AS created_at
        FROM (SELECT CAST(unnest(generate_series(DATE '1981-01-01', DATE '2030-12-31',
                                                 INTERVAL 1 DAY)) AS DATE) AS d))"""


def dim_governorate_cte() -> str:
    """CTE ``dim_governorate`` over the three standardized tables (the dedup keeps every name)."""
    names = " UNION ".join(f"SELECT governorate FROM std_{s}" for s in SOURCES)
    return (f"dim_governorate AS (SELECT row_number() OVER (ORDER BY governorate) AS governorate_key, "
            f"governorate AS governorate_name, {region_case('governorate')} AS region, "
            f"{RUN} AS created_at, {RUN} AS updated_at FROM ({names}))")


def _fact_columns(source: str) -> str:
    if source == "weather":
        return ("date, " + ", ".join(MEASURES[source].values()) + ", "
                + case_rules("temperature_2m_mean", L.TEMPERATURE_RULES) + " AS temperature_category, "
                + case_rules("relative_humidity_2m", L.HUMIDITY_RULES) + " AS humidity_category, "
                + case_rules("precipitation_corrected", L.PRECIPITATION_RULES) + " AS precipitation_category")
    column, rules, name = (
        ("air_quality_index", L.AIR_QUALITY_RULES, "air_quality_category") if source == "air_pollution"
        else ("all_sky_surface_uv_index", L.UV_INDEX_RULES, "uv_index_category"))
    return ("datetime, CAST(hour(datetime) AS INT) AS hour_of_day, "
            + ", ".join(MEASURES[source].values()) + f", {case_rules(column, rules)} AS {name}")


def gold_cte(*sources: str) -> str:
    """CTEs up to ``fact_x`` of the named sources, with both dimensions."""
    silver = ", ".join(silver_cte(s) if s in sources else standardized_cte(s) for s in SOURCES)
    facts = []
    for s in sources:
        stamp = "strftime(date, '%Y-%m-%d')" if s == "weather" else "strftime(datetime, '%Y-%m-%d %H:%M:%S') || '.000'"
        facts.append(
            f"fact_{s} AS (SELECT md5({stamp} || '-' || governorate) AS {FACT_KEYS[s]}, "
            f"g.governorate_key, t.date_key, {_fact_columns(s)}, load_timestamp, transform_timestamp, "
            f"{RUN} AS created_at FROM silver_{s} JOIN dim_governorate g ON governorate = g.governorate_name "
            f"LEFT JOIN (SELECT date_key, date_value FROM dim_date) t "
            f"ON CAST({TIME_COLUMN[s]} AS DATE) = t.date_value)")
    return ", ".join([silver, DIM_DATE, dim_governorate_cte(), *facts])


READINGS = f"readings AS ({readings_sql()})"


def with_readings(select: str) -> str:
    return f"WITH {READINGS} {select}"

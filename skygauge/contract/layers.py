"""Queries of the batch layers: silver, dimensions, facts, keys, bands and keyed merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge import lookups as L
from skygauge.contract import sqltext as S
from skygauge.contract.registry import query
from skygauge.contract.standins import RUN_TS, bronze, load, readings
from skygauge.functions.bands import classify, status
from skygauge.functions.keys import surrogate_key, timestamp_text
from skygauge.functions.names import canonical_name
from skygauge.functions.times import (from_epoch, from_parts, from_parts_text, to_epoch, utc_instant,
                                      utc_wall_clock)
from skygauge.functions.units import in_celsius
from skygauge.operators.keyed import (append_columns, latest_per_key, merge_frames, missed_rows, newer_than)
from skygauge.plans import gold
from skygauge.plans.silver import governorates, silver, unusable_rows
from skygauge.schemas import SOURCES
from skygauge.session import scratch_path
from skygauge.sources.csv_files import bronze_path, load_new_files, rejected_path
from skygauge.sources.tables import overwrite_table, read_table, upsert_table


# --- silver ----------------------------------------------------------------------------------

@query(f"WITH {S.silver_cte('weather')} SELECT * FROM silver_weather")
def silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(bronze(spark, sf_dir, "weather"), "weather", RUN_TS)


@query(f"WITH {S.silver_cte('air_pollution')} SELECT * FROM silver_air_pollution")
def silver_air_pollution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(bronze(spark, sf_dir, "air_pollution"), "air_pollution", RUN_TS)


@query(f"WITH {S.silver_cte('solar_energy')} SELECT * FROM silver_solar_energy")
def silver_solar_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(bronze(spark, sf_dir, "solar_energy"), "solar_energy", RUN_TS)


@query("WITH " + ", ".join(f"bronze_{s} AS ({S.bronze_sql(s)})" for s in SOURCES) + " " + " UNION ALL ".join(
    f"SELECT '{s}' AS source, city, {S.name_case('city', s)} AS governorate, count(*) AS n "
    f"FROM bronze_{s} GROUP BY ALL" for s in SOURCES))
def silver_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw and stored names of each source; NULL names are the ones dropped."""
    return reduce(DataFrame.unionByName, [
        bronze(spark, sf_dir, s).groupBy("city").agg(F.count("*").alias("n"))
        .select(F.lit(s).alias("source"), "city", canonical_name("city", s).alias("governorate"), "n")
        for s in SOURCES])


@query("WITH " + ", ".join(f"bronze_{s} AS ({S.bronze_sql(s)})" for s in SOURCES)
       + f" SELECT 'weather' AS source, count(*) AS dropped FROM bronze_weather WHERE {S.name_case('city', 'weather')} IS NULL"
         " UNION ALL SELECT 'air_pollution', count(*) FROM bronze_air_pollution WHERE city IS NULL"
         " UNION ALL SELECT 'solar_energy', count(*) FROM bronze_solar_energy WHERE hr > 23")
def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without usable name or time, counted per source."""
    return reduce(DataFrame.unionByName, [
        unusable_rows(bronze(spark, sf_dir, s), s).agg(F.count("*").alias("dropped"))
        .select(F.lit(s).alias("source"), "dropped") for s in SOURCES])


# --- dimensions ------------------------------------------------------------------------------

@query(f"""WITH {S.DIM_DATE}, sold AS (
        SELECT CAST(o_orderdate AS DATE) AS date_value, count(*) AS n FROM orders GROUP BY 1)
    SELECT dim_date.*, coalesce(n, 0) AS n_orders FROM dim_date LEFT JOIN sold USING (date_value)""")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of the dimension with its number of orders."""
    sold = (load(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date_value"))
            .agg(F.count("*").alias("n_orders")))
    return (gold.dim_date(spark, RUN_TS).join(sold, "date_value", "left")
            .fillna(0, subset=["n_orders"]))


def names_of(spark: SparkSession, sf_dir: str, *sources: str) -> list[DataFrame]:
    """Governorates of the sources; the dedup of silver keeps every name, so they are read before it."""
    return [governorates(bronze(spark, sf_dir, s), s) for s in sources]


_STANDARDIZED = ", ".join(S.standardized_cte(s) for s in SOURCES)


@query(f"WITH {_STANDARDIZED}, {S.dim_governorate_cte()} SELECT * FROM dim_governorate")
def dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_governorate(names_of(spark, sf_dir, *SOURCES), RUN_TS)


@query(f"""WITH {_STANDARDIZED},
    first AS (SELECT governorate, row_number() OVER (ORDER BY governorate) AS governorate_key
              FROM (SELECT DISTINCT governorate FROM std_solar_energy)),
    later AS (SELECT DISTINCT governorate FROM (SELECT governorate FROM std_weather
              UNION SELECT governorate FROM std_air_pollution)
              WHERE governorate NOT IN (SELECT governorate FROM first)),
    keyed AS (SELECT governorate, governorate_key FROM first UNION ALL
              SELECT governorate, (SELECT max(governorate_key) FROM first) + row_number() OVER (ORDER BY governorate)
              FROM later)
    SELECT governorate_key, governorate AS governorate_name, {S.region_case('governorate')} AS region,
           {S.RUN} AS created_at, {S.RUN} AS updated_at FROM keyed""")
def dim_region_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension built from one source, then extended by the others: old keys stay."""
    first = gold.dim_governorate(names_of(spark, sf_dir, "solar_energy"), RUN_TS)
    return gold.dim_governorate(names_of(spark, sf_dir, *SOURCES), RUN_TS, stored=first)


# --- facts -----------------------------------------------------------------------------------

def places_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The governorate dimension as a stored table, whose size the planner knows."""
    path = scratch_path(spark, "dim_governorate")
    gold.dim_governorate(names_of(spark, sf_dir, *SOURCES), RUN_TS).write.parquet(path)
    return spark.read.parquet(path)


def fact_of(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    places = places_table(spark, sf_dir)
    rows = silver(bronze(spark, sf_dir, source), source, RUN_TS)
    return gold.fact(rows, places, gold.dim_date(spark, RUN_TS), source, RUN_TS)


@query(f"WITH {S.gold_cte('weather')} SELECT * FROM fact_weather")
def fact_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_of(spark, sf_dir, "weather")


@query(f"WITH {S.gold_cte('air_pollution')} SELECT * FROM fact_air_pollution")
def fact_air_pollution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_of(spark, sf_dir, "air_pollution")


@query(f"WITH {S.gold_cte('solar_energy')} SELECT * FROM fact_solar_energy")
def fact_solar_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_of(spark, sf_dir, "solar_energy")


@query(f"WITH {S.gold_cte('weather')} SELECT fact_weather.* FROM fact_weather JOIN dim_governorate "
       "USING (governorate_key) WHERE governorate_name NOT IN (SELECT governorate FROM std_solar_energy)")
def fact_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts missed while their governorate had no key, found once the dimension has grown."""
    rows = silver(bronze(spark, sf_dir, "weather"), "weather", RUN_TS)
    days = gold.dim_date(spark, RUN_TS)
    places = places_table(spark, sf_dir)
    known = names_of(spark, sf_dir, "solar_energy")[0].withColumnRenamed("governorate", "governorate_name")
    early = places.join(known, "governorate_name", "left_semi").select(*places.columns)
    stored = gold.fact(rows, early, days, "weather", RUN_TS)
    return gold.repaired(rows, places, days, "weather", RUN_TS, stored)


# --- scalar functions ------------------------------------------------------------------------

@query(f"""SELECT event_id, md5(strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || '-' || user_id || '-' ||
        coalesce(nullif(event_type, 'view'), '{L.SURROGATE_NULL}')) AS row_key FROM events""")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.nullif(F.col("event_type"), F.lit("view"))
    return load(spark, sf_dir, "events").select(
        "event_id", surrogate_key(timestamp_text("ts"), F.col("user_id"), kind).alias("row_key"))


_BANDS = (
    ("temperature", "events", "value", L.TEMPERATURE_RULES),
    ("humidity", "part", "p_size", L.HUMIDITY_RULES),
    ("precipitation", "lineitem", "l_discount * 150", L.PRECIPITATION_RULES),
    ("air_quality", "lineitem", "l_quantity / 8.0", L.AIR_QUALITY_RULES),
    ("uv_index", "events", "value / 5.0E0 - 1.0E0", L.UV_INDEX_RULES),
)


@query(" UNION ALL ".join(
    f"SELECT '{m}' AS metric, {S.case_rules('v', rules)} AS category, count(*) AS n, min(v) AS low, max(v) AS high "
    f"FROM (SELECT CAST({v} AS DOUBLE) AS v FROM {t}) GROUP BY ALL" for m, t, v, rules in _BANDS))
def band_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    def one(metric, table, value, rules):
        rows = load(spark, sf_dir, table).select(F.expr(f"CAST({value} AS DOUBLE)").alias("v"))
        return (rows.groupBy(classify("v", rules).alias("category"))
                .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
                .select(F.lit(metric).alias("metric"), "category", "n", "low", "high"))
    return reduce(DataFrame.unionByName, [one(*b) for b in _BANDS])


_STATUS = {"temperature": "main_temp", "temperature_trend": "main_temp", "humidity": "main_humidity",
           "wind_speed": "wind_speed", "pressure": "main_pressure", "visibility": "visibility",
           "clouds": "clouds_all", "latency": "main_humidity", "wind_direction": "wind_deg",
           "message_rate": "clouds_all"}


def _status_case(metric: str, column: str) -> str:
    base, steps = L.STATUS_STEPS[metric]
    branches = f"WHEN {column} < {steps[0][1]} THEN '{base}' "
    bounds = [s[1] for s in steps][1:] + [None]
    for (colour, _), upper in zip(steps, bounds):
        branches += f"WHEN {column} IS NOT NULL THEN '{colour}' " if upper is None else \
            f"WHEN {column} < {upper} THEN '{colour}' "
    return f"CASE {branches} END"


@query(S.with_readings(" UNION ALL ".join(
    f"SELECT '{m}' AS metric, {_status_case(m, c)} AS status, count(*) AS n FROM readings GROUP BY ALL"
    for m, c in _STATUS.items())))
def status_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per metric and status colour, in one scan."""
    rows = readings(spark, sf_dir).select(*[status(c, m).alias(m) for m, c in _STATUS.items()])
    return (rows.unpivot([], list(_STATUS), "metric", "status")
            .groupBy("metric", "status").agg(F.count("*").alias("n")))


@query("""SELECT o_orderkey, CASE WHEN h < 24 THEN o_orderdate + to_hours(h) END AS from_parts,
           CASE WHEN h < 24 THEN o_orderdate + to_hours(h) END AS from_text
    FROM (SELECT *, CAST(o_orderkey % 26 AS INT) AS h FROM orders)""")
def ts_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
        F.dayofmonth("o_orderdate").alias("d"), (F.col("o_orderkey") % 26).cast("int").alias("h"))
    return rows.select("o_orderkey", from_parts("y", "m", "d", "h").alias("from_parts"),
                       from_parts_text("y", "m", "d", "h").alias("from_text"))


@query("""SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_seconds,
           date_trunc('second', ts) AS back FROM events""")
def epoch_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events").select("event_id", to_epoch(utc_instant("ts")).alias("epoch_seconds"))
    return rows.withColumn("back", utc_wall_clock(from_epoch("epoch_seconds")))


@query(S.with_readings("""SELECT id, round(main_temp, 2) AS main_temp, round(main_feels_like, 2) AS main_feels_like,
    round(main_temp_min, 2) AS main_temp_min, round(main_temp_max, 2) AS main_temp_max FROM readings"""))
def unit_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["main_temp", "main_feels_like", "main_temp_min", "main_temp_max"]
    kelvin = readings(spark, sf_dir).select("id", *[(F.col(c) + L.KELVIN_OFFSET).alias(c) for c in columns])
    return in_celsius(kelvin)


# --- incremental and keyed -------------------------------------------------------------------

@query("""SELECT 'update' AS run, l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
      FROM lineitem WHERE l_shipdate > (SELECT max(o_orderdate) FROM orders) GROUP BY ALL
    UNION ALL
    SELECT 'first', l_returnflag, count(*), CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT)
      FROM lineitem GROUP BY ALL""")
def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items newer than all orders loaded, and all of them against an empty target."""
    items = load(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "load_timestamp")
    orders = load(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "load_timestamp")

    def summary(rows: DataFrame, run: str) -> DataFrame:
        return (rows.groupBy("l_returnflag")
                .agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
                .select(F.lit(run).alias("run"), "l_returnflag", "n", "quantity"))
    return summary(newer_than(items, orders, "load_timestamp"), "update").unionByName(
        summary(newer_than(items, orders.filter(F.lit(False)), "load_timestamp"), "first"))


_LOADED = """loaded AS (SELECT * FROM orders WHERE o_orderdate < DATE '2000-01-01'),
    arrived AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0E0 AS o_totalprice, o_orderdate,
                       o_orderpriority FROM orders WHERE o_orderdate >= DATE '1999-01-01')"""


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as two loads that overlap by the year 1999; the second one restates the price."""
    orders = load(spark, sf_dir, "orders")
    price = (F.col("o_totalprice") + F.lit(1.0)).alias("o_totalprice")
    arrived = orders.select("o_orderkey", "o_custkey", "o_orderstatus", price, "o_orderdate", "o_orderpriority")
    return (orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")),
            arrived.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")))


_MERGED = f"""WITH {_LOADED}
    SELECT * FROM loaded WHERE o_orderkey NOT IN (SELECT o_orderkey FROM arrived)
    UNION ALL SELECT * FROM arrived"""


@query(_MERGED)
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded, arrived = _two_loads(spark, sf_dir)
    return merge_frames(loaded, arrived, ["o_orderkey"])


@query(_MERGED)
def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stored table that is partitioned by month; the update is applied twice."""
    path = scratch_path(spark, "orders")
    loaded, arrived = _two_loads(spark, sf_dir)
    for rows in (loaded, arrived, arrived):
        upsert_table(rows, path, ["o_orderkey"], ["o_totalprice"], "o_orderdate")
    return read_table(spark, path).drop("period")


@query(f"""WITH {_LOADED}
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL::VARCHAR AS o_orderpriority FROM loaded
    UNION ALL SELECT o_orderkey, o_custkey, NULL, o_totalprice, o_orderdate, o_orderpriority FROM arrived""")
def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load without priority, then one that adds it and lacks the status."""
    loaded, arrived = _two_loads(spark, sf_dir)
    return append_columns(loaded.drop("o_orderpriority"), arrived.drop("o_orderstatus"))


_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus"]


@query(f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {S.newest_first(_LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose key the line items lack (the re-read by key that repairs a table)."""
    seen = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return missed_rows(load(spark, sf_dir, "orders"), seen, ["o_orderkey"])


# --- CSV files -------------------------------------------------------------------------------

def _landed_weather(spark: SparkSession, sf_dir: str) -> str:
    """Loads CSV files of the weather table twice; some rows have an unreadable date."""
    place = scratch_path(spark, "csv")
    rows = bronze(spark, sf_dir, "weather").drop("load_timestamp")
    unreadable = F.col("prectotcorr") == 12
    rows = rows.withColumn("date", F.when(unreadable, F.lit("not a date")).otherwise(F.col("date").cast("string")))
    (rows.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(f"{place}/landing"))
    for _ in range(2):  # the second run finds no new files
        load_new_files(spark, f"{place}/landing", place, "weather", RUN_TS, file_glob="*.csv")
    return place


@query(f"WITH bronze AS ({S.bronze_sql('weather')}) SELECT * EXCLUDE (load_timestamp), {S.RUN} AS load_timestamp "
       "FROM bronze WHERE prectotcorr <> 12")
def csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of the files, each file counted once."""
    return read_table(spark, bronze_path(_landed_weather(spark, sf_dir), "weather")).drop("load_id")


@query(f"WITH bronze AS ({S.bronze_sql('weather')}) SELECT 'date' AS bad_columns, city, count(*) AS n "
       "FROM bronze WHERE prectotcorr = 12 GROUP BY ALL")
def csv_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows put aside, with the columns that could not be read."""
    rows = read_table(spark, rejected_path(_landed_weather(spark, sf_dir), "weather"))
    return (rows.groupBy(F.array_join("bad_columns", ",").alias("bad_columns"), "city")
            .agg(F.count("*").alias("n")))


# City names as a file holds them: quoted with a comma, with doubled quotes, with a last backslash, and plain.
_SPELLED = ("Port, Said", 'A "quoted" name', "ends with \\", "Giza")
_QUOTED = ['"' + name.replace('"', '""') + '"' for name in _SPELLED[:3]] + [_SPELLED[3]]


@query(f"""WITH lines AS (SELECT CASE o_orderkey % 4 {' '.join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(_SPELLED))} END AS city,
        CAST(o_orderdate AS DATE) AS date, CAST(o_orderkey % 50 AS DOUBLE) AS t2m,
        o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 AS ragged FROM orders)
    SELECT 'read' AS outcome, city, date, t2m, count(*) AS n FROM lines WHERE NOT ragged GROUP BY ALL
    UNION ALL SELECT 'field_count', NULL, NULL, NULL, count(*) FROM lines WHERE ragged""")
def csv_dialect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with quoted names, too few fields (every seventh) and too many (every eleventh), read as files."""
    place = scratch_path(spark, "dialect")
    key = F.col("o_orderkey")
    city = F.element_at(F.array(*[F.lit(q) for q in _QUOTED]), (key % 4 + 1).cast("int"))
    rest = F.when(key % 7 == 0, ",1").when(key % 11 == 0, ",1" * 15).otherwise(",1" * 13)
    line = F.concat(city, F.lit(","), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(","), (key % 50).cast("string"), rest)
    # One column without a separator or a quote of its own, so that the lines are written as they are.
    (load(spark, sf_dir, "orders").select(line.alias("line")).write.option("header", "true").option("sep", "\u0001")
     .option("quote", "").csv(f"{place}/landing"))
    load_new_files(spark, f"{place}/landing", place, "weather", RUN_TS, file_glob="*.csv")
    read = (read_table(spark, bronze_path(place, "weather")).groupBy("city", "date", "t2m").agg(F.count("*").alias("n"))
            .select(F.lit("read").alias("outcome"), "city", "date", "t2m", "n"))
    aside = read_table(spark, rejected_path(place, "weather")).groupBy(F.array_join("bad_columns", ",").alias("outcome"))
    return read.unionByName(aside.agg(F.count("*").alias("n")), allowMissingColumns=True)


@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def overwrite_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table, replaced as a whole by rows that are read from it."""
    path = scratch_path(spark, "replaced")
    overwrite_table(load(spark, sf_dir, "orders"), path)
    overwrite_table(read_table(spark, path).filter("o_orderstatus = 'F'"), path)
    return read_table(spark, path)

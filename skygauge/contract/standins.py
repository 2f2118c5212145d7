"""Weather tables derived from the given tables, once for Spark and once as DuckDB SQL.

Every row of the given table becomes one row here:

* ``orders``   -> daily weather files (bronze ``weather``)
* ``lineitem`` -> hourly air-quality files (bronze ``air_pollution``)
* ``events``   -> hourly solar files (bronze ``solar_energy``) and sensor readings

The expressions are plain SQL that both engines read, with the few differences filled in per
dialect. Only the input is shared: the operators and the SQL that checks them are separate.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from skygauge.lookups import SITES, STREAM_PARTITIONS

RUN_TS = "2030-01-01 00:00:00"

WEATHER_CITIES = ("Cairo", " giza ", "Alex", "Siwah", "Matrouh", "Sharm El Sheikh", "South Sinai",
                  "El Wadi El Gedid", "New Valley", "Sharkia", "Gulf of Suez", "Suez", "Aswan",
                  "Luxor", "Red Sea", "Fayoum", "Port Said", "Halayeb")
AIR_CITIES = ("Cairo", "Siwah", "Sharm _al-Shaykh", "elwady_elgaded", "Alex", "Ismailia", "Minya", "Asyut")
SOLAR_CITIES = ("cairo", " ALEX", "siwah", "Sharm El Sheikh", "El Wadi El Gedid", "Gulf of Suez", "Qena")


def _pick(element: str, make_list: str, index: str, values) -> str:
    """SQL that picks a value by its number, counted from 0."""
    quote = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) and v != "NULL" else str(v)
    return f"{element}({make_list}({', '.join(map(quote, values))}), CAST({index} AS INT) + 1)"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_SPARK = {
    "plus_hours": "timestampadd(HOUR, {n}, {ts})",
    "plus_seconds": "timestampadd(SECOND, {n}, {ts})",
    "json_k": "CAST(get_json_object(props, '$.k') AS INT)",
    "pick": partial(_pick, "element_at", "array"),
}
_DUCKDB = {
    "plus_hours": "({ts} + to_hours({n}))",
    "plus_seconds": "({ts} + to_seconds({n}))",
    "json_k": "CAST(json_extract_string(props, '$.k') AS INT)",
    "pick": partial(_pick, "list_extract", "list_value"),
}


def _weather(d: dict) -> tuple[str, dict[str, str]]:
    loaded = d["plus_hours"].format(n="CAST(o_orderkey % 24 AS INT)", ts="o_orderdate")
    t = "o_totalprice / 9973.0E0"
    return "orders", {
        "city": d["pick"]("o_custkey % 18", WEATHER_CITIES), "date": "CAST(o_orderdate AS DATE)",
        "t2m": t, "t2mdew": f"{t} - 5.0E0", "t2mwet": f"{t} - 2.5E0", "ts": f"{t} + 1.0E0",
        "t2m_range": "CAST(o_orderkey % 9 AS DOUBLE)", "t2m_max": f"{t} + 4.0E0", "t2m_min": f"{t} - 4.0E0",
        "qv2m": "CAST(o_orderkey % 20 AS DOUBLE)", "rh2m": "CAST(o_orderkey % 100 AS DOUBLE)",
        "prectotcorr": "CAST(o_orderkey % 13 AS DOUBLE)", "ps": "CAST(95 + o_orderkey % 10 AS DOUBLE)",
        "ws10m": "CAST(o_orderkey % 17 AS DOUBLE)", "ws10m_max": "CAST(o_orderkey % 17 + 3 AS DOUBLE)",
        "ws10m_min": "CAST(o_orderkey % 5 AS DOUBLE)", "load_timestamp": loaded,
    }


def _air_pollution(d: dict) -> tuple[str, dict[str, str]]:
    return "lineitem", {
        "city": d["pick"]("l_suppkey % 8", AIR_CITIES),
        "datetime": d["plus_hours"].format(n="CAST(l_orderkey % 24 AS INT)", ts="l_shipdate"),
        "aqi": "l_quantity / 8.0E0", "co": "l_extendedprice", "no": "l_discount", "no2": "l_tax",
        "o3": "l_quantity", "so2": "CAST(l_partkey % 50 AS DOUBLE)", "pm2_5": "l_extendedprice / 1000.0E0",
        "pm10": "l_extendedprice / 500.0E0", "nh3": "CAST(l_linenumber AS DOUBLE)",
        "load_timestamp": d["plus_hours"].format(n="CAST(l_linenumber AS INT)", ts="l_shipdate"),
    }


def _solar_energy(d: dict) -> tuple[str, dict[str, str]]:
    return "events", {
        "year": "CAST(year(ts) AS INT)", "mo": "CAST(month(ts) AS INT)", "dy": "CAST(day(ts) AS INT)",
        # Hours 24 and 25 do not exist: such rows have no valid time.
        "hr": "CAST((hour(ts) + user_id % 3) AS INT)",
        "allsky_sfc_sw_dwn": "value", "clrsky_sfc_sw_dwn": "value * 1.25E0 + user_id % 7",
        "allsky_sfc_sw_dni": "value / 2.0E0", "allsky_sfc_sw_diff": "value / 4.0E0",
        "allsky_sfc_par_tot": "value / 8.0E0", "clrsky_sfc_par_tot": "value / 16.0E0",
        "allsky_sfc_uva": "value / 32.0E0", "allsky_sfc_uvb": "value / 64.0E0",
        "allsky_sfc_uv_index": "value / 5.0E0", "city": d["pick"]("user_id % 7", SOLAR_CITIES),
        "load_timestamp": "ts",
    }


_BRONZE = {"weather": _weather, "air_pollution": _air_pollution, "solar_energy": _solar_energy}


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{e} AS `{n}`" for n, e in columns.items()]


def _sql(table: str, columns: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + f" FROM {table}"


def bronze(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    table, columns = _BRONZE[source](_SPARK)
    return load(spark, sf_dir, table).selectExpr(*_select(columns))


def bronze_sql(source: str) -> str:
    return _sql(*_BRONZE[source](_DUCKDB))


_SITE = "user_id % 28"
# Number 27 is a region the stream does not know.
_REGION_NAMES = [s[0] for s in SITES] + ["Sharqia"]
_PARTITION_OF = {g: n for n, names in STREAM_PARTITIONS.items() for g in names}


def _readings(d: dict) -> dict[str, str]:
    temp = "CASE WHEN event_type = 'signup' AND k < 10 THEN NULL ELSE value END"
    return {
        "id": "event_id", "governorate": d["pick"](_SITE, _REGION_NAMES),
        "kafka_partition": d["pick"](_SITE, [_PARTITION_OF.get(n, "NULL") for n in _REGION_NAMES]), "timestamp": "ts",
        "coord_lon": f"CAST({d['pick'](_SITE, [s[2] for s in SITES] + [0])} AS DOUBLE)",
        "coord_lat": f"CAST({d['pick'](_SITE, [s[1] for s in SITES] + [0])} AS DOUBLE)",
        "weather_main": "CASE event_type WHEN 'error' THEN 'Thunderstorm' WHEN 'signup' THEN 'Rain' "
                        "WHEN 'view' THEN 'Clouds' WHEN 'click' THEN 'Clear' ELSE 'Haze' END",
        "weather_description": "event_type", "main_temp": temp, "main_feels_like": "value - 0.5E0",
        "main_temp_min": "value - 1.5E0", "main_temp_max": "value + 1.5E0",
        "main_pressure": "980 + k", "main_humidity": "k", "visibility": "100 * k",
        "wind_speed": "k / 4.0E0", "wind_deg": "(37 * k) % 360", "clouds_all": "99 - k",
        "recorded_at": "ts", "processed_at": d["plus_seconds"].format(n="k", ts="ts"),
    }


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from(load(spark, sf_dir, "events"))


def readings_from(events: DataFrame) -> DataFrame:
    """Readings of the events table, or of a stream of it."""
    return events.selectExpr("*", f"{_SPARK['json_k']} AS k").selectExpr(*_select(_readings(_SPARK)))


def readings_sql() -> str:
    return _sql(f"(SELECT *, {_DUCKDB['json_k']} AS k FROM events)", _readings(_DUCKDB))

"""Declared schemas, as DDL text, and the measure names of the silver tables."""

from __future__ import annotations

# --- fixed values: CSV column order of the three bronze sources ---------------------------
BRONZE_COLUMNS: dict[str, str] = {
    "air_pollution": (
        "city STRING, datetime TIMESTAMP_NTZ, aqi DOUBLE, co DOUBLE, no DOUBLE, no2 DOUBLE, "
        "o3 DOUBLE, so2 DOUBLE, pm2_5 DOUBLE, pm10 DOUBLE, nh3 DOUBLE"
    ),
    "solar_energy": (
        "year INT, mo INT, dy INT, hr INT, allsky_sfc_sw_dwn DOUBLE, clrsky_sfc_sw_dwn DOUBLE, "
        "allsky_sfc_sw_dni DOUBLE, allsky_sfc_sw_diff DOUBLE, allsky_sfc_par_tot DOUBLE, "
        "clrsky_sfc_par_tot DOUBLE, allsky_sfc_uva DOUBLE, allsky_sfc_uvb DOUBLE, "
        "allsky_sfc_uv_index DOUBLE, city STRING"
    ),
    "weather": (
        "city STRING, date DATE, t2m DOUBLE, t2mdew DOUBLE, t2mwet DOUBLE, ts DOUBLE, "
        "t2m_range DOUBLE, t2m_max DOUBLE, t2m_min DOUBLE, qv2m DOUBLE, rh2m DOUBLE, "
        "prectotcorr DOUBLE, ps DOUBLE, ws10m DOUBLE, ws10m_max DOUBLE, ws10m_min DOUBLE"
    ),
}

# --- fixed values: bronze measure -> silver measure, in silver order ----------------------
MEASURES: dict[str, dict[str, str]] = {
    "air_pollution": {
        "aqi": "air_quality_index",
        "co": "carbon_monoxide",
        "no": "nitrogen_monoxide",
        "no2": "nitrogen_dioxide",
        "o3": "ozone",
        "so2": "sulfur_dioxide",
        "pm2_5": "particulate_matter_2_5",
        "pm10": "particulate_matter_10",
        "nh3": "ammonia",
    },
    "solar_energy": {
        "allsky_sfc_sw_dwn": "all_sky_surface_shortwave_downward",
        "clrsky_sfc_sw_dwn": "clear_sky_surface_shortwave_downward",
        "allsky_sfc_sw_dni": "all_sky_surface_shortwave_direct_normal",
        "allsky_sfc_sw_diff": "all_sky_surface_shortwave_diffuse",
        "allsky_sfc_par_tot": "all_sky_surface_par_total",
        "clrsky_sfc_par_tot": "clear_sky_surface_par_total",
        "allsky_sfc_uva": "all_sky_surface_uva",
        "allsky_sfc_uvb": "all_sky_surface_uvb",
        "allsky_sfc_uv_index": "all_sky_surface_uv_index",
    },
    "weather": {
        "t2m": "temperature_2m_mean",
        "t2mdew": "temperature_2m_dew_point",
        "t2mwet": "temperature_2m_wet_bulb",
        "ts": "earth_skin_temperature",
        "t2m_range": "temperature_2m_range",
        "t2m_max": "temperature_2m_maximum",
        "t2m_min": "temperature_2m_minimum",
        "qv2m": "specific_humidity_2m",
        "rh2m": "relative_humidity_2m",
        "prectotcorr": "precipitation_corrected",
        "ps": "surface_pressure",
        "ws10m": "wind_speed_10m_mean",
        "ws10m_max": "wind_speed_10m_maximum",
        "ws10m_min": "wind_speed_10m_minimum",
    },
}

SOURCES = ("air_pollution", "solar_energy", "weather")

# Time column of each silver table; with the governorate it is the key.
TIME_COLUMN = {"air_pollution": "datetime", "solar_energy": "datetime", "weather": "date"}

# --- fixed values: fields of one flattened reading ----------------------------------------
READING_FIELDS = (
    "coord_lon DOUBLE, coord_lat DOUBLE, weather_id INT, weather_main STRING, "
    "weather_description STRING, weather_icon STRING, base STRING, main_temp DOUBLE, "
    "main_feels_like DOUBLE, main_temp_min DOUBLE, main_temp_max DOUBLE, main_pressure INT, "
    "main_humidity INT, main_sea_level INT, main_grnd_level INT, visibility INT, "
    "wind_speed DOUBLE, wind_deg INT, clouds_all INT, dt BIGINT, sys_type INT, sys_id INT, "
    "sys_country STRING, sys_sunrise BIGINT, sys_sunset BIGINT, timezone INT, id INT, "
    "name STRING, cod INT, recorded_at STRING"
)
MESSAGE = (
    "governorate STRING, timestamp BIGINT, datetime STRING, partition INT, "
    f"data STRUCT<{READING_FIELDS}>"
)

# --- fixed values: nested answer of the weather API ---------------------------------------
API_RESPONSE = (
    "coord STRUCT<lon: DOUBLE, lat: DOUBLE>, "
    "weather ARRAY<STRUCT<id: INT, main: STRING, description: STRING, icon: STRING>>, "
    "base STRING, "
    "main STRUCT<temp: DOUBLE, feels_like: DOUBLE, temp_min: DOUBLE, temp_max: DOUBLE, "
    "pressure: INT, humidity: INT, sea_level: INT, grnd_level: INT>, "
    "visibility INT, wind STRUCT<speed: DOUBLE, deg: INT>, clouds STRUCT<all: INT>, dt BIGINT, "
    "sys STRUCT<type: INT, id: INT, country: STRING, sunrise: BIGINT, sunset: BIGINT>, "
    "timezone INT, id INT, name STRING, cod INT"
)


def column_names(ddl: str) -> list[str]:
    """Top-level names of a flat DDL text."""
    return [part.split()[0] for part in ddl.split(", ")]

"""Names, aliases, region classes, stream partitions, bands and thresholds.

The stored results depend on these values, so they are stated as they are and in one place.
"""

from __future__ import annotations

# --- fixed values: raw city name -> stored governorate, per batch source -----------------
# Names are compared after trim and upper case. None drops the row.
CITY_ALIASES: dict[str, dict[str, str | None]] = {
    "air_pollution": {
        "SIWAH": "MATROUH",
        "SHARM EL SHEIKH": "SOUTH SINAI",
        "ELWADY_ELGADED": "NEW VALLEY",
        "EL WADI EL GEDID": "NEW VALLEY",
        "SHARM _AL-SHAYKH": "SOUTH SINAI",
    },
    "solar_energy": {
        "SIWAH": "MATROUH",
        "SHARM EL SHEIKH": "SOUTH SINAI",
        "ELWADY_ELGADED": "NEW VALLEY",
        "EL WADI EL GEDID": "NEW VALLEY",
        "SHARM _AL-SHAYKH": "SOUTH SINAI",
        "ALEX": "ALEXANDRIA",
    },
    "weather": {
        "SIWAH": "MATROUH",
        "SHARM EL SHEIKH": "SOUTH SINAI",
        "ELWADY_ELGADED": "NEW VALLEY",
        "EL WADI EL GEDID": "NEW VALLEY",
        "SHARM _AL-SHAYKH": "SOUTH SINAI",
        "ALEX": "ALEXANDRIA",
        "SHARKIA": "SHARQIA",
        "GULF OF SUEZ": None,
    },
}

# --- fixed values: governorates of each region class -------------------------------------
REGION_CLASSES: dict[str, tuple[str, ...]] = {
    "Greater Cairo": ("CAIRO", "GIZA", "QALYUBIA"),
    "Alexandria and North Coast": ("ALEXANDRIA", "BEHEIRA", "KAFR EL SHEIKH", "MATROUH"),
    "Delta and Canal": ("DAKAHLIA", "SHARQIA", "GHARBIA", "MONUFIA", "DAMIETTA",
                        "PORT SAID", "ISMAILIA", "SUEZ"),
    "Upper Egypt": ("ASWAN", "LUXOR", "QENA", "SOHAG", "ASYUT", "MINYA", "BENI SUEF", "FAYOUM"),
    "Frontier Governorates": ("SOUTH SINAI", "NORTH SINAI", "RED SEA", "NEW VALLEY"),
}
OTHER_REGION = "Other"

# --- fixed values: stream partitions and the governorates they hold ----------------------
STREAM_PARTITIONS: dict[int, tuple[str, ...]] = {
    0: ("Alexandria", "Beheira", "Kafr El Sheikh", "Dakahlia", "Damietta", "Port Said",
        "Gharbia", "Monufia", "Qalyubia"),
    1: ("Cairo", "Giza", "Faiyum", "Beni Suef", "Minya", "Asyut", "Sohag", "Qena", "Helwan"),
    2: ("Luxor", "Aswan", "Red Sea", "South Sinai", "North Sinai", "Ismailia", "Suez",
        "Matruh", "New Valley"),
}
STREAM_PARTITION_NAMES: dict[int, tuple[str, str]] = {
    0: ("Northern Region", "Delta and Mediterranean coast"),
    1: ("Central Region", "Greater Cairo and Upper Egypt North"),
    2: ("Southern & Border Region", "Far South and desert regions"),
}

# --- fixed values: measuring sites (name, latitude, longitude) ---------------------------
SITES: tuple[tuple[str, float, float], ...] = (
    ("Cairo", 30.0444, 31.2357),
    ("Giza", 30.0131, 31.2089),
    ("Alexandria", 31.2001, 29.9187),
    ("Aswan", 24.0889, 32.8998),
    ("Asyut", 27.1793, 31.1836),
    ("Beheira", 31.34, 30.4715),
    ("Beni Suef", 29.0668, 31.099),
    ("Dakahlia", 31.0414, 31.3785),
    ("Damietta", 31.4167, 31.8133),
    ("Faiyum", 29.3086, 30.8418),
    ("Gharbia", 30.8766, 31.0354),
    ("Ismailia", 30.5965, 32.2715),
    ("Kafr El Sheikh", 31.1111, 30.9375),
    ("Luxor", 25.6872, 32.6396),
    ("Matruh", 31.354, 25.132),
    ("Minya", 28.0996, 30.75),
    ("Monufia", 30.4828, 31.0389),
    ("New Valley", 25.2083, 28.617),
    ("North Sinai", 30.3456, 33.9059),
    ("Port Said", 31.2653, 32.3019),
    ("Qalyubia", 30.3756, 31.1843),
    ("Qena", 26.155, 32.7167),
    ("Red Sea", 26.8206, 34.9456),
    ("Sohag", 26.5566, 31.694),
    ("South Sinai", 28.5392, 33.9739),
    ("Suez", 29.9668, 32.5498),
    ("Helwan", 29.8278, 31.3579),
)

# Spelling of the stream half -> spelling of the batch half, where upper case is not enough.
STREAM_TO_BATCH_NAMES: dict[str, str] = {"FAIYUM": "FAYOUM", "MATRUH": "MATROUH"}

# --- fixed values: category rules of the facts (label, comparison, bound), first hit wins -
Rules = tuple[tuple[str, str, float], ...]
TEMPERATURE_RULES: Rules = (("Cold", "<", 10), ("Mild", "<", 20), ("Warm", "<", 30), ("Hot", ">=", 30))
HUMIDITY_RULES: Rules = (("Dry", "<", 30), ("Comfortable", "<", 60), ("Humid", ">=", 60))
PRECIPITATION_RULES: Rules = (("No Rain", "=", 0), ("Light Rain", "<", 2.5),
                              ("Moderate Rain", "<", 10), ("Heavy Rain", ">=", 10))
AIR_QUALITY_RULES: Rules = (("Good", "<=", 1), ("Fair", "<=", 2), ("Moderate", "<=", 3),
                            ("Poor", "<=", 4), ("Very Poor", "<=", 5))
UV_INDEX_RULES: Rules = (("Low", "<=", 2), ("Moderate", "<=", 5), ("High", "<=", 7),
                         ("Very High", "<=", 10), ("Extreme", ">", 10))
UNKNOWN = "Unknown"

# --- fixed values: dashboard status steps (colour below the first bound, then colour, bound)
STATUS_STEPS: dict[str, tuple[str, tuple[tuple[str, float], ...]]] = {
    "temperature": ("blue", (("green", 15), ("orange", 25), ("red", 35))),
    "temperature_trend": ("blue", (("orange", 25), ("red", 35))),
    "humidity": ("red", (("orange", 30), ("green", 50), ("blue", 80))),
    "wind_speed": ("green", (("yellow", 5), ("orange", 10), ("red", 15))),
    "pressure": ("blue", (("green", 1010), ("yellow", 1020))),
    "visibility": ("red", (("orange", 1000), ("yellow", 5000), ("green", 8000))),
    "clouds": ("green", (("yellow", 25), ("orange", 50), ("blue", 75))),
    "latency": ("green", (("yellow", 5), ("red", 10))),
    "wind_direction": ("blue", (("green", 90), ("yellow", 180), ("orange", 270))),
    "message_rate": ("green", (("yellow", 100), ("red", 200))),
}

# --- fixed values: months of each season --------------------------------------------------
SEASONS: dict[str, tuple[int, ...]] = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Autumn": (9, 10, 11),
}

# --- fixed values: limits -----------------------------------------------------------------
DIM_DATE_START, DIM_DATE_END = "1981-01-01", "2030-12-31"
WEEKEND_DAYS = (6, 7)          # compared with Sunday = 0 .. Saturday = 6, so Saturday only
ALERT_CONDITIONS = ("Rain", "Thunderstorm", "Snow")
ALERT_HOT, ALERT_COLD, ALERT_WIND = 40, 5, 15
QUALITY_MIN_REGIONS, QUALITY_REGIONS, QUALITY_MIN_ROWS = 20, 27, 100
QUALITY_TEMPERATURES = (-10, 60)
RETENTION_DAYS = 90
KELVIN_OFFSET = 273.15
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"

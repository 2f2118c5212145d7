"""Temperature units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skygauge.lookups import KELVIN_OFFSET

TEMPERATURES = ("main_temp", "main_feels_like", "main_temp_min", "main_temp_max")


def kelvin_to_celsius(kelvin: Column | str) -> Column:
    kelvin = F.col(kelvin) if isinstance(kelvin, str) else kelvin
    return F.round(kelvin - F.lit(KELVIN_OFFSET), 2)


def in_celsius(readings: DataFrame, unit: str = "kelvin") -> DataFrame:
    """Readings with their four temperatures in Celsius."""
    if unit == "celsius":
        return readings
    if unit != "kelvin":
        raise ValueError(f"unit must be 'kelvin' or 'celsius', not {unit!r}")
    present = [c for c in TEMPERATURES if c in readings.columns]
    return readings.withColumns({c: kelvin_to_celsius(c) for c in present})

"""Dashboard queries over readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skygauge import lookups as L
from skygauge.functions.times import seconds_between
from skygauge.operators.keyed import latest_per_key
from skygauge.operators.pruning import between_times, from_time, newest_day

LATEST_COLUMNS = (
    "governorate", "timestamp", "main_temp", "main_feels_like", "main_humidity", "wind_speed",
    "weather_main", "weather_description", "clouds_all", "visibility", "recorded_at",
)
NEWEST_METRICS = ("main_temp", "main_humidity", "wind_speed", "main_pressure", "visibility",
                  "clouds_all", "wind_deg")


def in_range(df: DataFrame, start, end, column: str = "recorded_at") -> DataFrame:
    """Dashboard time filter, both ends included."""
    return between_times(df, column, start, end)


def match_region(df: DataFrame, pattern: str, column: str = "governorate") -> DataFrame:
    """Rows whose whole region name matches the pattern; ``.*`` keeps every named region."""
    if pattern == ".*":
        return df.filter(F.col(column).isNotNull())
    return df.filter(F.col(column).rlike(f"^(?:{pattern})$"))


def since(df: DataFrame, as_of: DataFrame | Column, interval: str, column: str = "timestamp") -> DataFrame:
    """Rows newer than ``interval`` before ``as_of`` (a timestamp column, or readings whose newest counts)."""
    back = F.expr(f"INTERVAL {interval}")
    if isinstance(as_of, DataFrame):
        # Subtract inside the subquery: the scan then compares with one plain value.
        bound = newest_day(as_of, column).agg((F.max(column) - back).alias("bound")).scalar()
    else:
        bound = as_of - back
    return from_time(df, column, bound, included=False)


def newest_of_regions(readings: DataFrame, time: str, columns: Sequence[str]) -> DataFrame:
    """Newest row of each region by ``time``.

    No region's newest row is older than the oldest of these newest times. That time comes from a
    hash aggregation over two columns and cuts the scan of all others to the recent rows, so that
    only those are sorted. A region that fell silent long ago makes the cut weaker, never wrong.
    """
    newest = readings.groupBy("governorate").agg(F.max(time).alias(time))
    oldest = newest.agg(F.min(time).alias("oldest")).scalar()
    recent = from_time(readings, time, oldest).select(*columns)
    return latest_per_key(recent, ["governorate"], [time])


def latest_weather(readings: DataFrame) -> DataFrame:
    return newest_of_regions(readings, "timestamp", LATEST_COLUMNS)


def latest_by_max_id(readings: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows that carry the greatest id of their region (the map panel)."""
    newest = readings.groupBy("governorate").agg(F.max(id_column).alias(id_column)).select(id_column)
    oldest = newest.agg(F.min(id_column).alias("oldest")).scalar()   # cuts the scan, as above
    return (readings.filter(F.col(id_column) >= oldest).join(newest, id_column, "left_semi")
            .select("governorate", F.col("coord_lat").alias("latitude"),
                    F.col("coord_lon").alias("longitude"), F.col("main_temp").alias("temperature"),
                    "weather_main", "weather_description"))


def newest_rows(df: DataFrame, time: str, top: int, ties: Sequence[str]) -> DataFrame:
    """The ``top`` newest rows; ``ties`` orders rows of one time."""
    return df.orderBy(F.desc(time), *ties).limit(top)


def choices(readings: DataFrame, column: str) -> DataFrame:
    """Values a dashboard offers for a choice."""
    return readings.select(column).distinct().orderBy(column)


def newest_values(readings: DataFrame, order_by: Sequence[str] = ("recorded_at", "timestamp")) -> DataFrame:
    """Newest value of the seven single-value panels, in one pass; NULL stays NULL."""
    newest = F.struct(*order_by)
    return readings.agg(*[F.max_by(m, newest).alias(m) for m in NEWEST_METRICS])


def statistics_table(readings: DataFrame) -> DataFrame:
    """Newest reading of each region by recording time, under the display names of the table."""
    columns = ("governorate", "main_temp", "main_humidity", "wind_speed", "main_pressure",
               "weather_main", "recorded_at")
    newest = newest_of_regions(readings, "recorded_at", columns)
    return (newest
            .withColumns({"main_temp": F.round("main_temp", 1), "wind_speed": F.round("wind_speed", 2)})
            .withColumnsRenamed({
                "governorate": "Governorate", "main_temp": "Temperature (°C)",
                "main_humidity": "Humidity (%)", "wind_speed": "Wind Speed (m/s)",
                "main_pressure": "Pressure (hPa)", "weather_main": "Condition",
                "recorded_at": "Last Update"})
            .orderBy("Governorate"))


def is_alert() -> Column:
    temp, wind = F.col("main_temp"), F.col("wind_speed")
    return ((temp > L.ALERT_HOT) | (temp < L.ALERT_COLD) | (wind > L.ALERT_WIND)
            | F.col("weather_main").isin(*L.ALERT_CONDITIONS))


def alerts(readings: DataFrame, top: int = 50) -> DataFrame:
    """Newest extreme readings under their display names."""
    return (readings.filter(is_alert())
            .select("governorate", "main_temp", "wind_speed", "weather_main", "recorded_at")
            .orderBy(F.desc("recorded_at"), "governorate", "main_temp", "wind_speed", "weather_main")
            .limit(top)
            .withColumnsRenamed({"governorate": "Location", "main_temp": "Temp (°C)",
                                 "wind_speed": "Wind (m/s)", "weather_main": "Condition",
                                 "recorded_at": "Time"}))


def condition_distribution(readings: DataFrame) -> DataFrame:
    return (readings.groupBy("weather_main").agg(F.count("*").alias("count"))
            .orderBy(F.desc("count"), "weather_main"))


def message_count(readings: DataFrame) -> DataFrame:
    return (readings.groupBy(F.col("kafka_partition").alias("metric"))
            .agg(F.count("*").alias("value")).orderBy("metric"))


def throughput(readings: DataFrame, partitions: str) -> DataFrame:
    """Messages per minute of processing and partition, for a partition list such as ``'0,2'``."""
    wanted = F.split(F.lit(partitions), ",").cast("array<int>")
    return (readings.filter(F.array_contains(wanted, F.col("kafka_partition")))
            .groupBy(F.window("processed_at", "1 minute").alias("w"),
                     F.col("kafka_partition").alias("metric"))
            .agg(F.count("*").alias("value"))
            .select(F.col("w.start").alias("time"), "metric", "value")
            .orderBy("time", "metric"))


def latency(readings: DataFrame) -> DataFrame:
    return readings.select(F.col("recorded_at").alias("time"), "governorate",
                           seconds_between("processed_at", "recorded_at").alias("latency"))


def temperature_series(readings: DataFrame) -> DataFrame:
    return (readings.select(F.col("recorded_at").alias("time"), F.col("governorate").alias("metric"),
                            F.col("main_temp").alias("value"))
            .orderBy("time", "metric"))


def metrics_long(readings: DataFrame, metrics: dict[str, str], time: str = "recorded_at",
                 keys: Sequence[str] = ()) -> DataFrame:
    """One row per reading and metric. ``metrics`` maps a column to the name shown; one scan."""
    wide = readings.select(F.col(time).alias("time"), *keys,
                           *[F.col(c).cast("double").alias(shown) for c, shown in metrics.items()])
    return wide.unpivot(["time", *keys], list(metrics.values()), "metric", "value")


def reduce_series(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Legend values of each series: last non-null by time, mean, max, min and sum.

    A series has one value per time, as the key of the readings makes sure. All buffers are of fixed
    width, so this is a hash aggregation.
    """
    known_at = F.when(F.col("value").isNotNull(), F.col("time"))
    return series.groupBy(*keys).agg(
        F.max_by("value", known_at).alias("last_not_null"),
        F.avg("value").alias("mean"), F.max("value").alias("max"),
        F.min("value").alias("min"), F.sum("value").alias("sum"))


def metrics_wide(series: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Series of one value per region and metric merged to a row per region."""
    return (series.groupBy("governorate").pivot("metric", list(metrics))
            .agg(F.first("value", ignorenulls=True)))

"""Statistics of readings from stored partial states.

A state holds of one hour, region and partition what statistics need: counts, mean, sum of squared deviations, extremes and
times. States merge by Chan's rule into those of days, regions or everything, in any order, with no loss of precision from
large means. Each micro-batch appends the states of the readings that it adds, in folders of its own, so a repeated
batch replaces its states; no reading is scanned for a statistic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skygauge.functions.times import bucket
from skygauge.operators.pruning import PERIOD
from skygauge.sources.tables import BATCH, append_batch, compact_days, read_table

HOUR = "hour"
KEYS = ("governorate", "kafka_partition")
_VALUE, _LOW, _HIGH = "main_temp", "main_temp_min", "main_temp_max"


def states_of(readings: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """A state for each hour and combination of keys. Readings without a value count as readings only."""
    value = F.col(_VALUE)
    return readings.groupBy(bucket("timestamp", "1 hour").alias(HOUR), *keys).agg(
        F.count("*").alias("readings"), F.count(value).alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("m2"), F.min(_LOW).alias("low"),
        F.max(_HIGH).alias("high"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


def _joined(a: Column, b: Column) -> Column:
    """Count, mean and squared deviations of two disjoint sets together (Chan's rule)."""
    n = a["n"] + b["n"]
    step = b["mean"] - a["mean"]
    share = F.when(n > 0, b["n"] / n).otherwise(F.lit(0.0))
    return F.struct(n.alias("n"), (a["mean"] + step * share).alias("mean"),
                    (a["m2"] + b["m2"] + step * step * a["n"] * share).alias("m2"))


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state for each combination of keys.

    A group's states are gathered in one task, so merge hours into days before days into more: then a group holds the
    hours of a day, or the days of the calendar, for each region and partition.
    """
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    parts = F.array_sort(F.collect_list(F.struct("n", "mean", "m2"))).alias("parts")
    gathered = states.groupBy(*keys).agg(
        F.sum("readings").alias("readings"), parts, F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("first").alias("first"), F.max("last").alias("last"))
    moments = F.aggregate("parts", none, _joined)
    return gathered.select(*keys, "readings", moments.alias("moments"), "low", "high", "first", "last").select(
        *keys, "readings", "moments.*", "low", "high", "first", "last")


def append_states(rows: DataFrame, path: str, batch_id: int) -> None:
    """Add the states of the readings of a micro-batch; a batch that comes again replaces its own."""
    append_batch(states_of(rows), path, batch_id, HOUR, [HOUR, *KEYS])


def compact_states(spark: SparkSession, path: str, before) -> int:
    """Merge the states of closed days, each hour to one state of each region and partition."""
    by = [HOUR, *KEYS, PERIOD]
    return compact_days(spark, path, before, [HOUR, *KEYS],
                        lambda rows: merge_states(rows, by).select(*[c for c in rows.columns if c != BATCH]))


def daily_states(spark: SparkSession, path: str) -> DataFrame:
    """A state for each day, region and partition."""
    return merge_states(read_table(spark, path), [PERIOD, *KEYS])


def _mean() -> Column:
    return F.when(F.col("n") > 0, F.col("mean"))


def region_statistics(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``governorate_temperature_stats``, from states."""
    merged = merge_states(daily_states(spark, path), ["governorate"])
    return merged.select(
        "governorate", F.col("readings").alias("total_readings"), _mean().alias("avg_temp"), F.col("low").alias("all_time_min"),
        F.col("high").alias("all_time_max"), F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("temp_stddev"),
        F.col("first").alias("first_reading"), F.col("last").alias("last_reading"))


def partition_statistics(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``partition_stats``, from states; each region has its own, so distinct regions are counted over them."""
    merged = merge_states(daily_states(spark, path), list(KEYS))
    regions = merged.groupBy("kafka_partition").agg(F.countDistinct("governorate").alias("governorate_count"))
    total = merge_states(merged, ["kafka_partition"])
    same = total["kafka_partition"].eqNullSafe(regions["kafka_partition"])
    return total.join(regions, same).select(
        total["kafka_partition"], F.col("readings").alias("total_records"), "governorate_count",
        F.col("first").alias("first_reading"), F.col("last").alias("last_reading"), _mean().alias("avg_temperature"))


def reading_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The row of ``ingest_metrics``, from states."""
    return read_table(spark, path).agg(
        F.coalesce(F.sum("readings"), F.lit(0)).alias("total_records"), F.countDistinct("governorate").alias("unique_governorates"),
        F.min("first").alias("first_record"), F.max("last").alias("last_record"))

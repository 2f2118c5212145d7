"""Measuring sites and stream partitions as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge import lookups as L
from skygauge.functions.names import partition_of


def sites(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(L.SITES), "name STRING, lat DOUBLE, lon DOUBLE")


def partition_members(spark: SparkSession) -> DataFrame:
    """One row per governorate with its stream partition."""
    rows = [(n, *L.STREAM_PARTITION_NAMES[n], g) for n, names in L.STREAM_PARTITIONS.items() for g in names]
    return spark.createDataFrame(rows, "partition INT, partition_name STRING, description STRING, "
                                       "governorate STRING")


def members_of(spark: SparkSession, partition: int) -> DataFrame:
    """Governorates of one partition."""
    if partition not in L.STREAM_PARTITIONS:
        raise ValueError(f"partition must be one of {sorted(L.STREAM_PARTITIONS)}, not {partition}")
    return partition_members(spark).filter(F.col("partition") == partition).select("governorate")


def partition_info(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """Members and totals of every partition, with the readings they sent."""
    # Readings of the 27 known names only, so both sides and the lists below are bounded.
    known = readings.filter(partition_of("governorate").isNotNull())
    sent = known.groupBy("governorate").agg(F.count("*").alias("readings"))
    return (partition_members(spark).join(F.broadcast(sent), "governorate", "left")
            .groupBy("partition", "partition_name", "description")
            .agg(F.sort_array(F.collect_list("governorate")).alias("governorates"),
                 F.count("*").alias("governorate_count"),
                 F.coalesce(F.sum("readings"), F.lit(0)).alias("readings")))


def with_partition(readings: DataFrame, strict: bool = False) -> DataFrame:
    """Readings with their stream partition; NULL marks a region to be put aside."""
    return readings.withColumn("kafka_partition", partition_of("governorate", strict))


def write_by_partition(readings: DataFrame, path: str) -> None:
    """Readings of known regions in one folder per stream partition.

    The rebalance keeps each partition in few files, yet lets Spark split one that is too large:
    three partitions do not mean three tasks.
    """
    (with_partition(readings).dropna(subset=["kafka_partition"])
     .hint("rebalance", F.col("kafka_partition"))
     .write.mode("overwrite").partitionBy("kafka_partition").parquet(path))

"""Health of the reading table: presence, freshness, quality and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skygauge.operators.quality import freshness, ingest_metrics, quality_summary
from skygauge.operators.serving import since
from skygauge.sources.ranges import read_between
from skygauge.sources.tables import read_table, table_exists


def readings_table(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists(spark, path):
        raise ValueError(f"no reading table at {path}")
    return read_table(spark, path)


def check_table(spark: SparkSession, path: str, as_of: Column) -> DataFrame:
    """Rows and newest time of the last hour; an error if the table is missing."""
    return freshness(since(readings_table(spark, path), as_of, "1 HOUR"))


def check_arrivals(spark: SparkSession, path: str, as_of: Column, interval: str = "30 SECONDS") -> bool:
    """True if a reading was processed within the interval; opens the days only that the index of ranges names."""
    readings_table(spark, path)
    bound = as_of - F.expr(f"INTERVAL {interval}")
    return not read_between(spark, path, "processed_at", bound).filter(F.col("processed_at") > bound).isEmpty()


def check_quality(spark: SparkSession, path: str, as_of: Column) -> DataFrame:
    """Summary and issues of the last six hours."""
    return quality_summary(since(readings_table(spark, path), as_of, "6 HOURS"))


def metrics(spark: SparkSession, path: str) -> DataFrame:
    return ingest_metrics(readings_table(spark, path))

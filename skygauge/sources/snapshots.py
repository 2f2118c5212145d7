"""Small tables that are kept as whole versions: notes beside a large table, and views of one row per region.

A version is a folder of its own and counts once its write has completed. So readers never find a table half written,
and a run or micro-batch that comes again replaces its own version with the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skygauge.sources.tables import folder_names, path_exists, remove_path, table_exists

VERSION = "version"
_KEPT = 2


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    if not path_exists(spark, path):
        return []
    numbers = sorted(int(n.split("=", 1)[1]) for n in folder_names(spark, path) if n.startswith(f"{VERSION}="))
    return [n for n in numbers if table_exists(spark, f"{path}/{VERSION}={n}")]


def read_snapshot(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest complete version, or the newest one below ``before``; None if there is none."""
    found = [n for n in versions(spark, path) if before is None or n < before]
    return spark.read.parquet(f"{path}/{VERSION}={found[-1]}") if found else None


def write_snapshot(df: DataFrame, path: str, version: int) -> None:
    """Write a version and drop all older ones but the last, which a reader may still hold.

    The rows may be derived from an older version.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/{VERSION}={version}")
    for old in [n for n in versions(spark, path) if n < version][:1 - _KEPT or None]:
        remove_path(spark, f"{path}/{VERSION}={old}")


def next_version(spark: SparkSession, path: str) -> int:
    return max(versions(spark, path), default=-1) + 1

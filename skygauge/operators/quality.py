"""Data-quality checks: failing rows, counts of failing rows, and thresholds on recent readings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge import lookups as L
from skygauge.operators.pruning import PERIOD


class Relationship(NamedTuple):
    column: str
    parent: str
    field: str


class TableChecks(NamedTuple):
    unique: tuple[str, ...]
    not_null: tuple[str, ...]
    relationships: tuple[Relationship, ...] = ()


def _fact_checks(key: str, time: str) -> TableChecks:
    dims = (Relationship("governorate_key", "dim_governorate", "governorate_key"),
            Relationship("date_key", "dim_date", "date_key"))
    return TableChecks((key,), (key, "governorate_key", "date_key", time), dims)


# 7 uniqueness, 19 not-null and 6 relationship checks.
GOLD_CHECKS: dict[str, TableChecks] = {
    "dim_governorate": TableChecks(("governorate_key", "governorate_name"),
                                   ("governorate_key", "governorate_name", "region")),
    "dim_date": TableChecks(("date_key", "date_value"), ("date_key", "date_value", "year", "season")),
    "fact_air_pollution": _fact_checks("air_pollution_key", "datetime"),
    "fact_solar_energy": _fact_checks("solar_energy_key", "datetime"),
    "fact_weather": _fact_checks("weather_key", "date"),
}


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts; NULL is no key."""
    return (df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n"))
            .filter("n > 1"))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child key values the parent lacks, with the number of child rows of each.

    Children are counted per key before the join, so a key that fills the table costs one row.
    """
    counted = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    known = parent.select(F.col(field).alias(column)).distinct()
    return counted.join(known, column, "left_anti")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose key the parent lacks."""
    known = parent.select(F.col(field).alias(column))
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti").select(*child.columns)


def _lines(failures: DataFrame, check: str, table: str, columns: Sequence[str]) -> DataFrame:
    """One line of the report for each column of the one row of ``failures``."""
    return failures.unpivot([], list(columns), "column", "failures").select(
        F.lit(check).alias("check"), F.lit(table).alias("table"), "column", "failures")


def _row_checks(name: str, tables: dict[str, DataFrame], checks: TableChecks, by: Sequence[str] = ()) -> DataFrame:
    """The not-null and relationship checks of a table, or of each of its parts ``by`` some columns, in one scan of it.

    Rows are counted per combination of the foreign keys before anything is joined, so a combination that fills
    the table sends one row per task, and the parents meet counts only.
    """
    links = checks.relationships
    counted = tables[name].groupBy(*by, *dict.fromkeys(r.column for r in links)).agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in checks.not_null])
    for place, (column, parent, field) in enumerate(links):
        known = tables[parent].select(F.col(field).alias(column)).distinct().withColumn(f"_known_{place}", F.lit(True))
        counted = counted.join(known, column, "left")
    orphans = [F.sum(F.when(F.col(r.column).isNotNull() & F.col(f"_known_{place}").isNull(), F.col("_n")))
               for place, r in enumerate(links)]
    sums = [("not_null", c, F.sum(f"_null_{c}")) for c in checks.not_null]
    sums += [("relationships", r.column, total) for r, total in zip(links, orphans)]
    found = [F.struct(F.lit(check).alias("check"), F.lit(name).alias("table"), F.lit(column).alias("column"),
                      F.coalesce(total, F.lit(0)).alias("failures")) for check, column, total in sums]
    return counted.groupBy(*by).agg(F.array(*found).alias("found")).select(*by, F.inline("found"))


def table_report(name: str, tables: dict[str, DataFrame], checks: TableChecks) -> DataFrame:
    """Failing-row count of every check of one table: one scan for each key, and one for all other checks."""
    df = tables[name]
    if checks.relationships:
        parts = [_row_checks(name, tables, checks)]
    else:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in checks.not_null])
        parts = [_lines(nulls, "not_null", name, checks.not_null)]
    for column in checks.unique:
        failing = duplicate_keys(df, [column]).agg(F.count("*").alias(column))
        parts.append(_lines(failing, "unique", name, [column]))
    return reduce(DataFrame.unionByName, parts)


def report_by_period(name: str, tables: dict[str, DataFrame], checks: TableChecks, period: str = PERIOD) -> DataFrame:
    """(period, check, table, column, failures) for each period of a table whose keys determine the period.

    So a key can be repeated within its period only, and results of periods can be added up.
    """
    parts = [_row_checks(name, tables, checks, [period])]
    for column in checks.unique:
        failing = duplicate_keys(tables[name], [period, column]).groupBy(period).agg(F.count("*").alias("failures"))
        parts.append(failing.select(period, F.lit("unique").alias("check"), F.lit(name).alias("table"),
                                    F.lit(column).alias("column"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def declared_checks(spark: SparkSession, name: str, checks: TableChecks) -> DataFrame:
    """A line without failures for each declared check of a table."""
    lines = [("not_null", name, c) for c in checks.not_null] + [("unique", name, c) for c in checks.unique]
    lines += [("relationships", name, r.column) for r in checks.relationships]
    return spark.createDataFrame(lines, "check STRING, table STRING, column STRING").withColumn(
        "failures", F.lit(0).cast("long"))


def quality_report(tables: dict[str, DataFrame], checks: dict[str, TableChecks] | None = None) -> DataFrame:
    """(check, table, column, failures) of all checks."""
    checks = GOLD_CHECKS if checks is None else checks
    return reduce(DataFrame.unionByName, [table_report(n, tables, c) for n, c in checks.items()])


def failing_rows(tables: dict[str, DataFrame], check: str, table: str, column: str,
                 checks: dict[str, TableChecks] | None = None) -> DataFrame:
    """The rows behind one line of the report."""
    df = tables[table]
    if check == "not_null":
        return null_rows(df, column)
    if check == "unique":
        return duplicate_keys(df, [column])
    if check == "relationships":
        checks = GOLD_CHECKS if checks is None else checks
        link = next(r for r in checks[table].relationships if r.column == column)
        return orphan_rows(df, column, tables[link.parent], link.field)
    raise ValueError(f"unknown check {check!r}")


def store_failures(tables: dict[str, DataFrame], report: DataFrame, audit_path: str,
                   periods: dict[tuple[str, str, str], list] | None = None) -> int:
    """Write the failing rows of each failed check below ``audit_path``; returns how many failed.

    The report has one row per declared check, so reading it on the driver is bounded. ``periods`` names those of a
    check (by check, table and column) that have failures, so that no others are read.
    """
    failed = report.filter("failures > 0").collect()
    for row in failed:
        some = (periods or {}).get((row["check"], row["table"], row["column"]))
        own = tables if some is None else {
            **tables, row["table"]: tables[row["table"]].filter(F.col(PERIOD).isin(some))}
        rows = failing_rows(own, row["check"], row["table"], row["column"])
        rows.write.mode("overwrite").parquet(f"{audit_path}/{row['check']}_{row['table']}_{row['column']}")
    return len(failed)


def quality_summary(recent: DataFrame) -> DataFrame:
    """Coverage, volume and temperature of recent readings, with the list of issues."""
    summary = recent.agg(F.countDistinct("governorate").alias("gov_count"),
                         F.count("*").alias("total_records"), F.avg("main_temp").alias("avg_temp"),
                         F.min("main_temp").alias("min_temp"), F.max("main_temp").alias("max_temp"))
    low, high = L.QUALITY_TEMPERATURES
    few, total, mean = F.col("gov_count"), F.col("total_records"), F.col("avg_temp")
    issues = F.array(
        F.when(few < L.QUALITY_MIN_REGIONS,
               F.format_string(f"Low governorate coverage: %d/{L.QUALITY_REGIONS}", few)),
        F.when(total < L.QUALITY_MIN_ROWS, F.format_string("Low record count: %d", total)),
        F.when((mean < low) | (mean > high),
               F.concat(F.lit("Suspicious avg_temp: "), mean.cast("string"))))
    return summary.withColumn("issues", F.array_compact(issues))


def ingest_metrics(readings: DataFrame) -> DataFrame:
    return readings.agg(F.count("*").alias("total_records"),
                        F.countDistinct("governorate").alias("unique_governorates"),
                        F.min("timestamp").alias("first_record"), F.max("timestamp").alias("last_record"))


def freshness(recent: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows and newest time of recent readings, in all or per key."""
    return recent.groupBy(*keys).agg(F.count("*").alias("records"), F.max("timestamp").alias("latest"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table; Parquet answers these from its footers."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in tables.items()])


def newest_per_table(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Newest date of each table; ``tables`` gives the date column."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.max(F.to_date(c)).alias("newest")).select(F.lit(n).alias("table_name"), "newest")
        for n, (df, c) in tables.items()])


def daily_counts(df: DataFrame, column: str, year: int, top: int = 10) -> DataFrame:
    """Rows per date of a year, newest dates first.

    The year is a range on the raw column, which the Parquet scan can use to skip row groups.
    """
    start, end = F.lit(f"{year}-01-01").cast("timestamp_ntz"), F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
    return (df.filter((F.col(column) >= start) & (F.col(column) < end))
            .groupBy(F.to_date(column).alias("date")).agg(F.count("*").alias("row_count"))
            .orderBy(F.desc("date")).limit(top))


def complete_sites(sites: DataFrame) -> DataFrame:
    """Sites with a name and both coordinates; zero and empty count as missing."""
    return sites.filter((F.col("name") != "") & (F.col("lat") != 0) & (F.col("lon") != 0))

"""The batch run: files to bronze, silver, gold and the quality report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from skygauge.operators.pruning import PERIOD
from skygauge.operators.quality import (GOLD_CHECKS, declared_checks, report_by_period, store_failures, table_counts,
                                        table_report)
from skygauge.plans import gold
from skygauge.plans.silver import silver, silver_keys
from skygauge.schemas import BRONZE_COLUMNS, SOURCES, TIME_COLUMN
from skygauge.session import shuffles_for
from skygauge.sources.changes import changed_after, last_change, note_changes
from skygauge.sources.csv_files import bronze_path, load_new_files
from skygauge.sources.snapshots import next_version, read_snapshot, write_snapshot
from skygauge.sources.tables import (ROW_BYTES, folder_bytes, folder_names, overwrite_table, path_exists,
                                     read_if_exists, read_table, table_exists, upsert_table)


def silver_path(warehouse: str, source: str) -> str:
    return f"{warehouse}/silver/{source}"


def gold_path(warehouse: str, table: str) -> str:
    return f"{warehouse}/gold/{table}"


def load_bronze(spark: SparkSession, landing: str, warehouse: str, run_ts, **options) -> None:
    """Load the new files of all sources. A failed source does not stop the others; it raises at the end."""
    failures = []
    for source in SOURCES:
        try:
            load_new_files(spark, landing, warehouse, source, run_ts, **options)
        except Exception as error:  # noqa: BLE001 - all sources are tried first
            failures.append((source, error))
    if failures:
        names = ", ".join(s for s, _ in failures)
        raise RuntimeError(f"bronze load failed for {names}") from failures[0][1]


def loads(spark: SparkSession, warehouse: str, source: str) -> list[int]:
    """Numbers of the complete loads of a source: one for each micro-batch that found files."""
    path = bronze_path(warehouse, source)
    if not path_exists(spark, path):
        return []
    numbers = [int(n.split("=", 1)[1]) for n in folder_names(spark, path) if n.startswith("load_id=")]
    return sorted(n for n in numbers if table_exists(spark, f"{path}/load_id={n}"))


def read_bronze_table(spark: SparkSession, warehouse: str, source: str, after: int | None = None) -> DataFrame | None:
    """All loads of a source, None before the first one; with ``after`` only the folders of later loads are opened.

    The declared schema saves reading footers.
    """
    path = bronze_path(warehouse, source)
    if not loads(spark, warehouse, source):
        return None
    schema = f"{BRONZE_COLUMNS[source]}, load_timestamp TIMESTAMP_NTZ"
    rows = spark.read.schema(schema).parquet(path)
    return (rows if after is None else rows.filter(F.col("load_id") > after)).drop("load_id")


def _taken_path(warehouse: str, source: str) -> str:
    return silver_path(warehouse, source) + "__taken"


def taken_load(spark: SparkSession, warehouse: str, source: str) -> int | None:
    """The last load that silver holds; None if silver or the note of it is missing, so that all loads count."""
    note = read_if_exists(spark, _taken_path(warehouse, source))
    return None if note is None or not table_exists(spark, silver_path(warehouse, source)) else note.first()["load_id"]


def build_silver(spark: SparkSession, warehouse: str, run_ts) -> None:
    """Bring the loads that silver lacks into it.

    The last load taken is noted once its rows are stored, so neither older loads nor silver itself are read to
    find out what is new. A run that stops before the note takes its loads again, which the upsert allows. Without
    a note, the high-water mark of silver decides.
    """
    for source in SOURCES:
        path = silver_path(warehouse, source)
        stored, taken = read_if_exists(spark, path), taken_load(spark, warehouse, source)
        fresh = [n for n in loads(spark, warehouse, source) if taken is None or n > taken]
        if not fresh:
            continue
        size = sum(folder_bytes(spark, f"{bronze_path(warehouse, source)}/load_id={n}") for n in fresh)
        bronze = read_bronze_table(spark, warehouse, source, taken)
        with shuffles_for(spark, ROW_BYTES * size):
            new = silver(bronze, source, run_ts, stored if taken is None else None)
            note_changes(spark, path, upsert_table(new, path, silver_keys(source), ["load_timestamp"], TIME_COLUMN[source]))
        overwrite_table(spark.range(fresh[-1], fresh[-1] + 1).toDF("load_id"), _taken_path(warehouse, source))


def build_dimensions(spark: SparkSession, warehouse: str, run_ts, refresh: bool = False) -> None:
    """Build the dimensions if absent; ``refresh`` adds the names that came since."""
    days = gold_path(warehouse, "dim_date")
    if not table_exists(spark, days):
        overwrite_table(gold.dim_date(spark, run_ts), days)
    places = gold_path(warehouse, "dim_governorate")
    stored = read_if_exists(spark, places)
    if stored is None or refresh:
        tables = [read_table(spark, silver_path(warehouse, s)) for s in SOURCES
                  if table_exists(spark, silver_path(warehouse, s))]
        overwrite_table(gold.dim_governorate(tables, run_ts, stored), places)


def _fact_note_path(warehouse: str, source: str) -> str:
    return gold_path(warehouse, f"fact_{source}") + "__taken"


def _note_fact(spark: SparkSession, warehouse: str, source: str, run: int, periods: list, note: Row | None) -> None:
    """Note the silver run that a fact holds, and its high-water mark.

    The mark is the greatest of the noted one and that of the periods just written, so the fact isn't scanned for it.
    If no row of the run has landed, as all lacked a dimension row, the mark stays and so does the note: the next
    run takes the rows again, as the mark alone would have it.
    """
    fact = read_table(spark, gold_path(warehouse, f"fact_{source}"))
    written = fact if note is None else fact.filter(F.col(PERIOD).isin(periods))
    mark = written.agg(F.max("transform_timestamp")).first()[0]
    if mark is not None and (note is None or mark > note["high_water"]):
        row = spark.createDataFrame([(run, mark)], "run LONG, high_water TIMESTAMP_NTZ")
        overwrite_table(row, _fact_note_path(warehouse, source))


def build_facts(spark: SparkSession, warehouse: str, run_ts, repair: bool = False) -> None:
    """Bring the silver rows that the facts lack into them.

    The change log of silver names the periods to open, and the noted mark tells their new rows: neither other
    periods nor the fact are read. Without a note or a log, the mark is taken from the fact and all of silver is read.
    """
    places = read_table(spark, gold_path(warehouse, "dim_governorate"))
    days = read_table(spark, gold_path(warehouse, "dim_date"))
    for source in SOURCES:
        origin = silver_path(warehouse, source)
        if not table_exists(spark, origin):
            continue
        rows = read_table(spark, origin)
        path = gold_path(warehouse, f"fact_{source}")
        stored, run = read_if_exists(spark, path), last_change(spark, origin)
        notes = read_if_exists(spark, _fact_note_path(warehouse, source)) if stored is not None else None
        note = None if notes is None else notes.first()
        if repair and stored is not None:
            new = gold.repaired(rows, places, days, source, run_ts, stored)
        elif note is None or run is None:
            new = gold.fact(rows, places, days, source, run_ts, stored)
        else:
            changed = changed_after(spark, origin, note["run"])
            if not changed:
                continue
            fresh = rows.filter(F.col(PERIOD).isin(changed) & (F.col("transform_timestamp") > F.lit(note["high_water"])))
            new = gold.fact(fresh, places, days, source, run_ts)
        periods = upsert_table(new, path, [gold.FACT_KEYS[source]], ["load_timestamp"], TIME_COLUMN[source])
        note_changes(spark, path, periods)
        if run is not None and not repair:
            _note_fact(spark, warehouse, source, run, periods, note)


def gold_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    names = ["dim_governorate", "dim_date", *[f"fact_{s}" for s in SOURCES]]
    return {n: read_table(spark, gold_path(warehouse, n)) for n in names
            if table_exists(spark, gold_path(warehouse, n))}


def _checked_periods(spark: SparkSession, warehouse: str, name: str, tables: dict[str, DataFrame], everything: bool) -> DataFrame:
    """Stored results of a fact's checks by period, those of changed periods computed anew.

    Periods with keys that a dimension lacked are checked again too, as the dimension may have got them since. Keys
    never leave a dimension; after one was rebuilt by hand, check ``everything``.
    """
    path, results = gold_path(warehouse, name), f"{warehouse}/audit/by_period/{name}"
    run, known = last_change(spark, path), read_snapshot(spark, results)
    upto = None if known is None else known.agg(F.max("upto")).first()[0]
    if everything or run is None or upto is None:
        fresh, periods = tables, None
    else:
        orphans = known.filter("check = 'relationships' and failures > 0").select(PERIOD).distinct()
        periods = sorted({*changed_after(spark, path, upto), *(r[0] for r in orphans.collect())})
        fresh = {**tables, name: tables[name].filter(F.col(PERIOD).isin(periods))}
    if periods is None or periods:
        found = report_by_period(name, fresh, GOLD_CHECKS[name])
        if periods is not None:
            found = known.drop("upto").filter(~F.col(PERIOD).isin(periods)).unionByName(found)
        write_snapshot(found.withColumn("upto", F.lit(-1 if run is None else run).cast("long")), results,
                       next_version(spark, results))
    return read_snapshot(spark, results).drop("upto")


def check_gold(spark: SparkSession, warehouse: str, everything: bool = False) -> DataFrame:
    """The quality report of the gold tables; failing rows are kept below ``audit``.

    Facts are checked by period, and of stored results only those of changed periods are computed again.
    """
    tables = gold_tables(spark, warehouse)
    path = f"{warehouse}/audit/report"
    facts = [n for n in tables if n.startswith("fact_")]
    size = sum(folder_bytes(spark, gold_path(warehouse, n)) for n in tables)
    with shuffles_for(spark, size):  # only keys are shuffled, about the size of the compressed rows
        checked = {n: _checked_periods(spark, warehouse, n, tables, everything) for n in facts}
        lines = [table_report(n, tables, GOLD_CHECKS[n]) for n in tables if n not in facts]
        for n, found in checked.items():
            both = declared_checks(spark, n, GOLD_CHECKS[n]).unionByName(found.drop(PERIOD))
            lines.append(both.groupBy("check", "table", "column").agg(F.sum("failures").alias("failures")))
        reduce(DataFrame.unionByName, lines).write.mode("overwrite").parquet(path)
    report = spark.read.parquet(path)
    failing: dict[tuple[str, str, str], list] = {}
    for found in checked.values():  # a line for each failing check and period at most
        for row in found.filter("failures > 0").collect():
            failing.setdefault((row["check"], row["table"], row["column"]), []).append(row[PERIOD])
    store_failures(tables, report, f"{warehouse}/audit", failing)
    return report


def bronze_counts(spark: SparkSession, warehouse: str) -> DataFrame:
    tables = {s: read_bronze_table(spark, warehouse, s) for s in SOURCES}
    return table_counts({s: t for s, t in tables.items() if t is not None})


def run_batch(spark: SparkSession, landing: str, warehouse: str, run_ts, refresh_dimensions: bool = False,
              repair_facts: bool = False, **load_options) -> DataFrame:
    """One whole run over the new files; returns the quality report.

    ``run_ts`` is the load time of the new rows, and must be later than that of the runs before: the
    incremental filters compare with it.
    """
    load_bronze(spark, landing, warehouse, run_ts, **load_options)
    build_silver(spark, warehouse, run_ts)
    build_dimensions(spark, warehouse, run_ts, refresh_dimensions)
    build_facts(spark, warehouse, run_ts, repair_facts)
    return check_gold(spark, warehouse)

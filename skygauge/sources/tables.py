"""Parquet tables: full overwrite, keyed upsert by period, retention, and a JDBC sink.

A keyed table is partitioned by ``period``, a day or month derived from its key (in UTC for instants),
so that a key always lives in one partition and an upsert rewrites only the partitions it touches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge.functions.times import is_instant, ts_literal, utc_day, utc_instant, utc_wall_clock
from skygauge.operators.keyed import latest_per_key
from skygauge.operators.pruning import PERIOD
from skygauge.session import shuffles_for

#: Bytes that rows take in a shuffle for each byte of them in a Parquet file; adaptive execution merges what is too much.
ROW_BYTES = 4

#: Partition below the day of an appended table: the micro-batch that wrote the rows, below 0 for merged ones.
BATCH = "batch_id"
_COMPACTING, _COMPACTED_NOTE = "__compacting", "__compacted"
_PENDING = "__pending"
_SCHEMA = "__schema"
_NEW = "__new"


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, location = _filesystem(spark, path)
    return fs.exists(location)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, location = _filesystem(spark, path)
    fs.delete(location, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder."""
    fs, location = _filesystem(spark, path)
    return [entry.getPath().getName() for entry in fs.listStatus(location)]


def _periods(spark: SparkSession, path: str) -> list[str]:
    """Names of the period folders."""
    return [n for n in folder_names(spark, path) if n.startswith(f"{PERIOD}=")]


def _files(spark: SparkSession, path: str) -> list[str]:
    return [n for n in folder_names(spark, path) if n.endswith(".parquet")]


def _stored_bytes(spark: SparkSession, path: str, periods: Sequence) -> int:
    """Bytes on disk of the given periods of a table."""
    folders = [f"{path}/{PERIOD}={p}" for p in periods]
    sizes = [folder_bytes(spark, f) for f in folders if path_exists(spark, f)]
    return sum(sizes)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a folder; reads no contents."""
    fs, location = _filesystem(spark, path)
    return fs.getContentSummary(location).getLength()


def table_exists(spark: SparkSession, path: str) -> bool:
    """True once a write to the path has completed, or a stream has written to it."""
    return any(path_exists(spark, f"{path}/{mark}") for mark in ("_SUCCESS", "_spark_metadata"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table with the columns of all its files.

    A keyed table keeps its schema beside it, so no file footers are read to find the columns.
    """
    if table_exists(spark, path + _SCHEMA):
        return spark.read.schema(spark.read.parquet(path + _SCHEMA).schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def _keep_schema(df: DataFrame, path: str, stored: DataFrame | None) -> None:
    """Write the schema, as a table without rows, before the rows that need it."""
    if stored is None or stored.columns != df.columns:
        df.limit(0).write.mode("overwrite").parquet(path + _SCHEMA)  # planned as an empty relation


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table for its writer, a cut-off write completed first; None if there is none."""
    _publish(spark, path)
    return read_table(spark, path) if table_exists(spark, path) else None


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a table as a whole. The new rows may be derived from the old table."""
    df.write.mode("overwrite").parquet(path + _PENDING)
    _publish(df.sparkSession, path)


def _by_period(df: DataFrame, sort_by: Sequence[str]) -> DataFrame:
    """Each period in few partitions; adaptive execution splits a period that is too large."""
    return df.hint("rebalance", F.col(PERIOD)).sortWithinPartitions(PERIOD, *sort_by)


def _write_pending(df: DataFrame, path: str, sort_by: Sequence[str], stored: DataFrame | None = None,
                   parts: Sequence[str] = (PERIOD,)) -> None:
    _keep_schema(df, path, stored)
    _by_period(df, sort_by).write.mode("overwrite").partitionBy(*parts).parquet(path + _PENDING)


def _publish(spark: SparkSession, path: str) -> None:
    """Move the folders of a complete pending write into the table.

    A run that stopped on the way left the rest in the pending folder, and the next call moves it.
    """
    pending = path + _PENDING
    if table_exists(spark, pending):
        periods = _periods(spark, pending)
        for period in periods:
            _move(spark, f"{pending}/{period}", f"{path}/{period}")
        if periods:
            _move(spark, f"{pending}/_SUCCESS", f"{path}/_SUCCESS")
        elif _files(spark, pending):  # a table without periods is replaced as a whole
            _move(spark, pending, path)
    if path_exists(spark, pending):
        remove_path(spark, pending)


def merged(target: DataFrame, updates: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The newest row of each key of both sides, in one aggregation; of equal order a row of ``updates`` counts.

    Neither side is joined, so both are read once and shuffled once. Columns that only one side has are NULL
    on the other. Where the target lacks a column of ``order_by`` its rows give way to the updates.
    """
    both = target.withColumn(_NEW, F.lit(0)).unionByName(updates.withColumn(_NEW, F.lit(1)), allowMissingColumns=True)
    known = set(order_by) <= set(target.columns)
    return latest_per_key(both, keys, [*order_by, _NEW] if known else [_NEW, *order_by]).drop(_NEW)


def _period_last(df: DataFrame) -> DataFrame:
    """Columns in the order a partitioned table is read in."""
    return df.select(*[c for c in df.columns if c != PERIOD], PERIOD)


def with_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; a NULL in one of the columns fails the job that reads it."""
    return df.withColumns({c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is NULL, a part of the key")))
                           .otherwise(F.col(c)) for c in dict.fromkeys(columns)})


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder or file in the place of another; a rename, so no data passes through Spark."""
    fs, place = _filesystem(spark, target)
    fs.delete(place, True)
    fs.mkdirs(place.getParent())
    if not fs.rename(_filesystem(spark, source)[1], place):
        raise OSError(f"could not move {source} to {target}")


def with_period(rows: DataFrame, time_column: str, grain: str = "day") -> DataFrame:
    """The rows with the period that a keyed or appended table puts them in."""
    day = utc_day(F.col(time_column), is_instant(rows, time_column))
    return rows.withColumn(PERIOD, day if grain == "day" else F.trunc(day, grain))


def upsert_table(updates: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str],
                 time_column: str, grain: str = "month") -> list:
    """Insert or replace rows by key; the newest row of a key by ``order_by`` stays, stored or new.

    So loads may come twice or out of order; of rows with equal order the new one counts.
    ``time_column`` must be part of the key or determined by it. A row without it, or without a part
    of the key, is an error: set such rows aside before. Only the periods in the updates
    are read and written. The merged periods are first written aside in full, then put in the place
    of the old ones; if the run stops in between, the next upsert finishes that step. One writer at
    a time. Returns the periods touched, one value for each day or month at most.
    """
    spark = updates.sparkSession
    _publish(spark, path)
    rows = with_period(with_keys(updates, [*keys, time_column]), time_column, grain)
    match = [*keys, PERIOD]
    if not table_exists(spark, path):
        _write_pending(_period_last(latest_per_key(rows, match, order_by)), path, keys)
        _publish(spark, path)
        stored = _periods(spark, path) if path_exists(spark, path) else []  # no folder without rows
        return [date.fromisoformat(p.split("=", 1)[1]) for p in stored]
    rows = rows.persist()
    try:
        # One value per calendar day or month: bounded by the time span, and it prunes the scan.
        periods = [r[0] for r in rows.select(PERIOD).distinct().collect()]
        if periods:
            stored = read_table(spark, path)
            target = stored.filter(F.col(PERIOD).isin(periods))
            with shuffles_for(spark, ROW_BYTES * _stored_bytes(spark, path, periods)):
                _write_pending(_period_last(merged(target, rows, match, order_by)), path, keys, stored)
    finally:
        rows.unpersist()
    _publish(spark, path)
    return periods


def replace_range(fresh: DataFrame, path: str, time_column: str, start, end, sort_by: Sequence[str]) -> None:
    """Replace the rows of a day-partitioned table with ``start <= time < end`` by ``fresh``.

    Rows outside the range stay; only the days of the range are read and written.
    """
    spark = fresh.sparkSession
    _publish(spark, path)
    instant = is_instant(fresh, time_column)

    def text(bound):
        return (utc_wall_clock(bound) if instant else bound).cast("timestamp_ntz").cast("string")

    def literal(bound: str):
        return utc_instant(ts_literal(bound)) if instant else ts_literal(bound)

    last = end - F.expr("INTERVAL 1 MICROSECOND")
    bounds = spark.range(1).select(text(start), text(end), utc_day(start, instant), utc_day(last, instant)).first()
    lo, hi, first_day, last_day = literal(bounds[0]), literal(bounds[1]), str(bounds[2]), str(bounds[3])
    time = F.col(time_column)
    fresh = fresh.filter((time >= lo) & (time < hi)).withColumn(PERIOD, utc_day(time, instant))
    stored_days, stored = [], None
    if table_exists(spark, path):
        stored_days = [p for p in _periods(spark, path) if first_day <= p.split("=", 1)[1] <= last_day]
        days = F.col(PERIOD).between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
        stored = read_table(spark, path)
        kept = stored.filter(days & ((time < lo) | (time >= hi)))
        fresh = _period_last(kept.unionByName(fresh, allowMissingColumns=True))
    _write_pending(fresh, path, sort_by, stored)
    emptied = set(stored_days) - set(_periods(spark, path + _PENDING))
    _publish(spark, path)
    for day in emptied:
        remove_path(spark, f"{path}/{day}")


def replace_buckets(fresh: DataFrame, buckets: DataFrame, path: str, time_column: str, sort_by: Sequence[str]) -> None:
    """Replace the rows of a day-partitioned table whose time is one of ``buckets`` (distinct, one column of that name).

    Other rows of those days stay; only the days of the buckets are read and written.
    """
    spark = fresh.sparkSession
    _publish(spark, path)
    days = [r[0] for r in with_period(buckets, time_column).select(PERIOD).distinct().collect()]  # bounded by the calendar
    if not days:
        return
    fresh, stored = with_period(fresh, time_column), None
    if table_exists(spark, path):
        stored = read_table(spark, path)
        kept = stored.filter(F.col(PERIOD).isin(days)).join(buckets, time_column, "left_anti")
        fresh = _period_last(kept.select(*stored.columns).unionByName(fresh, allowMissingColumns=True))
    _write_pending(fresh, path, sort_by, stored)
    _publish(spark, path)


def append_batch(rows: DataFrame, path: str, batch_id: int, time_column: str, sort_by: Sequence[str]) -> None:
    """Add the rows of a micro-batch in day folders, each with a folder of the batch; nothing stored is read.

    A batch that comes again replaces its own folders, so its rows are there once.
    """
    spark = rows.sparkSession
    rows = with_period(rows, time_column).withColumn(BATCH, F.lit(batch_id).cast("long"))
    known = spark.read.parquet(path + _SCHEMA) if table_exists(spark, path + _SCHEMA) else None
    _keep_schema(rows if known is None else known.unionByName(rows.limit(0), allowMissingColumns=True), path, known)
    if not table_exists(spark, path):
        rows.limit(0).write.mode("append").partitionBy(PERIOD, BATCH).parquet(path)  # marks the table as there
    (_by_period(rows, sort_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(PERIOD, BATCH).parquet(path))


def _finish_compaction(spark: SparkSession, path: str) -> None:
    """Put merged batches in the place of those they hold, as the note of a complete compaction says."""
    pending, note = path + _COMPACTING, path + _COMPACTED_NOTE
    if table_exists(spark, note):
        done = spark.read.parquet(note).groupBy(PERIOD).agg(F.collect_list(BATCH).alias("batches"), F.first("merged").alias("merged"))
        for row in done.collect():  # one row for each day
            day = f"{PERIOD}={row[PERIOD]}"
            for batch in row["batches"]:
                remove_path(spark, f"{path}/{day}/{BATCH}={batch}")
            if path_exists(spark, merged := f"{pending}/{day}/{BATCH}={row['merged']}"):
                _move(spark, merged, f"{path}/{day}/{BATCH}={row['merged']}")
        remove_path(spark, note)
    if path_exists(spark, pending):
        remove_path(spark, pending)


def compact_days(spark: SparkSession, path: str, before, sort_by: Sequence[str],
                 merge: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Rewrite the days before a date that several batches have written, each into few files; returns how many.

    Only the batches there at the start are merged and removed, so rows that a stream adds to such a day meanwhile
    stay. A batch being written at the same time may come again and would replace files merged already, so the days
    have to be older than the batch in progress; late readings go to folders of their own. What is removed is noted
    before: a run that stops is completed by the next one. ``merge`` may reduce the rows that are put together.
    """
    _finish_compaction(spark, path)
    parts, merged = [], {}
    for day in _periods(spark, path):
        period = day.split("=", 1)[1]
        batches = [int(n.split("=", 1)[1]) for n in folder_names(spark, f"{path}/{day}") if n.startswith(f"{BATCH}=")]
        if period < str(before) and (len(batches) > 1 or any(n >= 0 for n in batches)):
            parts += [(period, n, min([0, *batches]) - 1) for n in batches]
            merged[period] = min([0, *batches]) - 1
    if parts:
        note = spark.createDataFrame(parts, f"{PERIOD} STRING, {BATCH} LONG, merged LONG").withColumn(
            PERIOD, F.col(PERIOD).cast("date"))
        stored = read_table(spark, path)
        # a list of days beside the join, so that other folders aren't listed or opened
        rows = stored.join(note.drop("merged"), [PERIOD, BATCH]).filter(
            F.col(PERIOD).isin([date.fromisoformat(p) for p in merged])).select(*stored.columns)
        rows = rows if merge is None else merge(rows)
        rows = rows.drop(BATCH).join(F.broadcast(note.select(PERIOD, F.col("merged").alias(BATCH)).distinct()), PERIOD)
        with shuffles_for(spark, ROW_BYTES * sum(folder_bytes(spark, f"{path}/{PERIOD}={p}") for p in merged)):
            _by_period(rows, sort_by).write.mode("overwrite").partitionBy(PERIOD, BATCH).parquet(path + _COMPACTING)
        note.write.mode("overwrite").parquet(path + _COMPACTED_NOTE)
        _finish_compaction(spark, path)
    return len(merged)


def drop_periods_before(spark: SparkSession, path: str, first_kept) -> int:
    """Delete the day folders older than ``first_kept`` (a date); reads no data."""
    old = [p for p in _periods(spark, path) if p.split("=", 1)[1] < str(first_kept)]
    for period in old:
        remove_path(spark, f"{path}/{period}")
    return len(old)


def write_jdbc(df: DataFrame, url: str, table: str, driver: str, **options: str) -> None:
    """Append to a database table; user and password come in ``options`` only."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table).option("driver", driver)
     .options(**options).mode("append").save())


def read_jdbc(spark: SparkSession, url: str, query: str, driver: str, **options: str) -> DataFrame:
    return (spark.read.format("jdbc").option("url", url).option("query", query)
            .option("driver", driver).options(**options).load())

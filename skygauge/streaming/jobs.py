"""Streaming jobs over readings: dedup, rollups, keyed sink, and the file source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from skygauge.operators.keyed import latest_per_key
from skygauge.operators.pruning import PERIOD, newest_day
from skygauge.operators.rollups import weather_daily, weather_hourly
from skygauge.plans.latest_view import merge_latest
from skygauge.plans.rollup_tables import note_invalid
from skygauge.plans.stat_states import append_states
from skygauge.session import adaptive
from skygauge.sources.deltas import read_merged, upsert_delta
from skygauge.sources.ranges import widen_ranges
from skygauge.sources.tables import (BATCH, append_batch, path_exists, read_table, table_exists, upsert_table, with_period,
                                     write_jdbc)
from skygauge.streaming.messages import accepted, flat_readings, parse, rejected

READING_KEY = ("timestamp", "governorate")
#: Of several states of a reading the one processed last counts.
READING_ORDER = ("processed_at",)
HOURLY_DELAY, DAILY_DELAY = "3 hours", "3 days"


def read_files(spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet",
               files_per_trigger: int | None = None) -> DataFrame:
    """Stream of a file, or of the files below a folder.

    The path is given as a pattern, so that one file and a folder of part files both work.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    path = path.rstrip("/")
    return reader.load(f"{path[:-1]}[{path[-1]}]")


def distinct_readings(readings: DataFrame, delay: str = HOURLY_DELAY) -> DataFrame:
    """Readings without repeats of (governorate, timestamp) that arrive within ``delay``."""
    return readings.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(READING_KEY))


def _watermarked(readings: DataFrame, delay: str | None) -> DataFrame:
    return readings.withWatermark("timestamp", delay) if delay else readings


def hourly_stream(readings: DataFrame, delay: str | None = HOURLY_DELAY) -> DataFrame:
    """Hourly rollup; an hour is emitted once, when it lies behind the watermark.

    ``delay`` is None for readings that carry a watermark already, as ``distinct_readings`` gives.
    """
    return weather_hourly(_watermarked(readings, delay))


def daily_stream(readings: DataFrame, delay: str | None = DAILY_DELAY) -> DataFrame:
    return weather_daily(_watermarked(readings, delay))


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def write_files(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append a stream to Parquet files; without an interval it ends when all input is read."""
    return (stream.writeStream.format("parquet").option("path", path).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start())


_BRANCH, _UNIQUE, _ALL = "__branch", 0, 1


def _has_key() -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in READING_KEY])


def _watermark_bound(spark: SparkSession, path: str, delay: str) -> Column | None:
    """A time at or after the stream's watermark: the newest stored time less the delay, as a literal; None for an
    empty table. Read from the last day's folder."""
    if not table_exists(spark, path):
        return None
    newest = newest_day(read_table(spark, path), "timestamp").agg(F.max("timestamp") - F.expr(f"INTERVAL {delay}"))
    bound = newest.first()[0]
    return None if bound is None else F.lit(bound)


def _stored_keys(spark: SparkSession, path: str, late: DataFrame, batch_id: int) -> DataFrame:
    """Keys of stored readings among which those of ``late`` rows can be, without those of the batch itself.

    Files are sorted by time within a day, so of the days of late rows only the row groups of their times are read.
    """
    spans = late.groupBy(PERIOD).agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last")).collect()
    stored = read_table(spark, path).filter(F.col(BATCH) != batch_id)
    if not spans:  # one value for each day of the calendar at most
        return stored.select(*READING_KEY).limit(0)
    stored = stored.filter(F.col(PERIOD).isin([s[PERIOD] for s in spans]))
    stored = stored.filter(F.col("timestamp").between(min(s["first"] for s in spans), max(s["last"] for s in spans)))
    return stored.select(*READING_KEY)


def _unseen(late: DataFrame, unique: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Late rows, one for each key, whose key neither the table nor the batch's other rows have."""
    spark = late.sparkSession
    order = [c for c in ("processed_at",) if c in late.columns]
    late = latest_per_key(late, READING_KEY, order)
    known = _stored_keys(spark, path, with_period(late, "timestamp"), batch_id)
    return late.join(known.unionByName(unique.select(*READING_KEY)), list(READING_KEY), "left_anti").select(*late.columns)


def _check_owner(spark: SparkSession, path: str, checkpoint: str) -> None:
    if table_exists(spark, path) and not path_exists(spark, checkpoint):
        raise ValueError(f"{path} was written with another checkpoint, whose batches a new one would replace")


def append_readings(readings: DataFrame, path: str, checkpoint: str, interval: str | None = "30 seconds",
                    delay: str = HOURLY_DELAY, quarantine: str | None = None, latest: str | None = None,
                    states: str | None = None) -> StreamingQuery:
    """Append each reading once, in day folders; for rates at which rewriting a day is too much.

    The stream drops repeats within ``delay`` by its state, so readings in time are neither compared with stored
    ones nor rewritten. Those behind the watermark, which that state would lose, come by a second branch of the same
    stream: one of each key is joined to the stored keys of its day and time, and appended if it's new. Their hours are
    noted, so that rollups can be mended (``refresh_invalid``).

    A repeated micro-batch replaces its own files. Readings without time or governorate go to the ``quarantine``
    folder; without one they are an error. ``latest`` is the path of a view of the newest reading per region that is
    kept along, ``states`` that of partial states of its statistics (``plans.stat_states``). The days' ranges of the other clocks are kept too (``sources.ranges``). Closed days are merged into
    few files with ``compact_days``; old ones go by reading time, with ``drop_periods_before``.

    A table belongs to one checkpoint, as folders are named by its batches.
    """
    _check_owner(readings.sparkSession, path, checkpoint)
    unique = distinct_readings(readings.filter(_has_key()), delay).withColumn(_BRANCH, F.lit(_UNIQUE))
    both = unique.unionByName(readings.withColumn(_BRANCH, F.lit(_ALL)))

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        with adaptive(own):
            bound = _watermark_bound(own, path, delay)
            behind = F.lit(False) if bound is None else F.col("timestamp") <= bound
            # the stream's state is updated once, when these rows are first computed
            kept = batch.filter((F.col(_BRANCH) == _UNIQUE) | ~_has_key() | behind).persist()
            try:
                if not kept.isEmpty():  # a batch may only move the watermark
                    _write_batch(kept, batch_id, behind, path, quarantine, latest, states)
            finally:
                kept.unpersist()

    return (both.writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start())


def _write_batch(kept: DataFrame, batch_id: int, behind: Column, path: str, quarantine: str | None, latest: str | None,
                 states: str | None) -> None:
    on_time = kept.filter(F.col(_BRANCH) == _UNIQUE).drop(_BRANCH)
    rest = kept.filter(F.col(_BRANCH) == _ALL).drop(_BRANCH)
    bad, late = rest.filter(~_has_key()), rest.filter(_has_key() & behind)
    if not bad.isEmpty():
        if quarantine is None:
            raise ValueError("readings without time or governorate, and no quarantine folder")
        bad.write.mode("overwrite").parquet(f"{quarantine}/{BATCH}={batch_id}")
    new = None if late.isEmpty() else _unseen(late, on_time.filter(behind), path, batch_id).persist()
    try:
        rows = on_time
        if new is not None:
            note_invalid(new, path, batch_id)
            rows = on_time.unionByName(new)
        widen_ranges(with_period(rows, "timestamp"), path, batch_id)  # before the rows, which it has to cover
        append_batch(rows, path, batch_id, "timestamp", READING_KEY)
        if latest is not None:
            merge_latest(rows, latest, batch_id)
        if states is not None:
            append_states(rows, states, batch_id)
    finally:
        if new is not None:
            new.unpersist()


def upsert_readings(readings: DataFrame, path: str, checkpoint: str,
                    interval: str | None = "30 seconds", quarantine: str | None = None) -> StreamingQuery:
    """Keep the reading table by key, in day partitions. A repeated micro-batch changes nothing.

    Readings without time or governorate go to the ``quarantine`` folder; without one they are an error.

    Each micro-batch rewrites the days it touches: for readings that may be restated, at moderate
    rates. ``append_readings`` serves high rates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        usable = F.col("timestamp").isNotNull() & F.col("governorate").isNotNull()
        if quarantine and not (bad := batch.filter(~usable)).isEmpty():
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
        rows = batch.filter(usable) if quarantine else batch
        if not rows.isEmpty():
            with adaptive(batch.sparkSession):
                widen_ranges(with_period(rows, "timestamp"), path)
                upsert_table(rows, path, READING_KEY, ["processed_at"], "timestamp", grain="day")

    return (readings.writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start())


def _add_deltas(rows: DataFrame, path: str, batch_id: int, delay: str) -> None:
    """Store the rows of a micro-batch as deltas. The index of ranges is widened before, as it has to cover them; the
    hours behind the newest reading less ``delay`` are noted afterwards, so that a refresh never takes a note whose
    rows aren't there. A batch that stopped in between comes again and does all of it anew."""
    bound = _watermark_bound(rows.sparkSession, path, delay)
    widen_ranges(with_period(rows, "timestamp"), path, batch_id)
    upsert_delta(rows, path, batch_id, READING_KEY, READING_ORDER, "timestamp")
    if bound is not None and not (behind := rows.filter(F.col("timestamp") <= bound)).isEmpty():
        note_invalid(behind, path, batch_id)


def merge_readings(readings: DataFrame, path: str, checkpoint: str, interval: str | None = "30 seconds",
                   quarantine: str | None = None, delay: str = HOURLY_DELAY) -> StreamingQuery:
    """Keep the reading table by key, merged when it's read; for readings that may be restated, at high rates.

    Each micro-batch adds files of its own below the days of its rows, so a late or restated reading costs a small file
    where ``upsert_readings`` rewrites its day. ``current_readings`` gives the newest state of each reading; closed days
    are merged with ``sources.deltas.compact_deltas``. Hours that were changed behind the newest reading less ``delay``
    are noted, so that stored rollups can be mended (``refresh_invalid``).

    A repeated micro-batch replaces its own files; after its days were compacted it adds rows that are merged away.
    Readings without time or governorate go to the ``quarantine`` folder; without one they are an error. A table belongs
    to one checkpoint, as deltas are numbered by its batches.
    """
    _check_owner(readings.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            batch = batch.persist()
            try:
                if quarantine and not (bad := batch.filter(~_has_key())).isEmpty():
                    bad.write.mode("overwrite").parquet(f"{quarantine}/{BATCH}={batch_id}")
                rows = batch.filter(_has_key()) if quarantine else batch
                if not rows.isEmpty():
                    _add_deltas(rows, path, batch_id, delay)
            finally:
                batch.unpersist()

    return (readings.writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start())


def current_readings(spark: SparkSession, path: str, periods: list | None = None) -> DataFrame:
    """The newest state of each reading that ``merge_readings`` stored, with its ``period``; of the given days only."""
    return read_merged(spark, path, READING_KEY, READING_ORDER, periods)


def append_jdbc(readings: DataFrame, url: str, table: str, driver: str, checkpoint: str,
                interval: str | None = "30 seconds", **options: str) -> StreamingQuery:
    """Append micro-batches to a database table, whose primary key guards against repeats."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_jdbc(batch, url, table, driver, **options)

    return (readings.writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start())


def ingest_messages(messages: DataFrame, table: str, quarantine: str, checkpoint: str,
                    interval: str | None = "30 seconds", unit: str = "celsius",
                    merge_on_read: bool = False) -> StreamingQuery:
    """Message text to the reading table; unusable messages go to the quarantine folder.

    The days of a micro-batch are rewritten, or get its rows as deltas, to be read with ``current_readings``.
    """
    if merge_on_read:
        _check_owner(messages.sparkSession, table, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(batch).persist()
        try:
            bad = rejected(parsed)
            if not bad.isEmpty():
                bad.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
            good = accepted(parsed)
            if not good.isEmpty():
                with adaptive(batch.sparkSession):
                    rows = flat_readings(good, unit=unit)
                    if merge_on_read:
                        _add_deltas(rows, table, batch_id, HOURLY_DELAY)
                    else:
                        widen_ranges(with_period(rows, "timestamp"), table)
                        upsert_table(rows, table, READING_KEY, READING_ORDER, "timestamp", grain="day")
        finally:
            parsed.unpersist()

    return (messages.writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start())

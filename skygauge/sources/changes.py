"""Which periods of a keyed table each run has changed, so that those who read it open these only.

One row per period: the number of the run that touched it last. Numbers ascend by one for each noted run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession, functions as F

from skygauge.operators.pruning import PERIOD
from skygauge.sources.snapshots import next_version, read_snapshot, versions, write_snapshot

CHANGED = "changed"


def changes_path(path: str) -> str:
    return path + "__changes"


def note_changes(spark: SparkSession, path: str, periods: Sequence) -> None:
    """Note that a run has changed the periods; call it once the rows are published.

    If a run stops before, its updates are taken again by the next one, which then notes them.
    """
    if not periods:
        return
    log = changes_path(path)
    run = next_version(spark, log)
    rows = spark.createDataFrame([(p, run) for p in periods], f"{PERIOD} DATE, {CHANGED} LONG")
    known = read_snapshot(spark, log)
    both = rows if known is None else known.unionByName(rows)
    write_snapshot(both.groupBy(PERIOD).agg(F.max(CHANGED).alias(CHANGED)), log, run)


def last_change(spark: SparkSession, path: str) -> int | None:
    """The number of the last noted run; None if none was."""
    return max(versions(spark, changes_path(path)), default=None)


def changed_after(spark: SparkSession, path: str, run: int) -> list:
    """Periods that runs after ``run`` have changed; one value for each at most."""
    log = read_snapshot(spark, changes_path(path))
    return [] if log is None else sorted(r[0] for r in log.filter(F.col(CHANGED) > run).select(PERIOD).collect())

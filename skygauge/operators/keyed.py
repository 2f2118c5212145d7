"""Latest row per key, keyed merge, and incremental filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skygauge.functions.times import ts_literal

EPOCH = "1970-01-01 00:00:00"


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by all other columns.

    ``max`` over a struct combines on the map side, so a key that holds a large part of all
    rows sends one row per task over the network, never its whole group. The remaining columns
    break ties, which makes the result independent of row order.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    newest = F.max(F.struct(*order_by, *rest)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*df.columns)


def merge_frames(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``updates`` replaced or added by key.

    ``updates`` must hold each key once (see ``latest_per_key``). Columns that only one side has
    are kept and NULL on the other.
    """
    match = updates.select(*keys)
    kept = target.join(match, list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(updates, allowMissingColumns=True)


def append_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; new columns come last, and missing values are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def high_water(target: DataFrame, column: str) -> Column:
    """Newest value of ``column`` in the target, the epoch if there is none, as a scalar subquery."""
    newest = F.coalesce(F.max(F.col(column).cast("timestamp_ntz")), ts_literal(EPOCH))
    return target.agg(newest.alias("high_water")).scalar()


def newer_than(source: DataFrame, target: DataFrame | None, column: str) -> DataFrame:
    """Source rows above the high-water mark of the target; all rows if there is no target."""
    if target is None:
        return source
    return source.filter(F.col(column) > high_water(target, column))


def missed_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks: repairs what the high-water mark skipped."""
    return source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)

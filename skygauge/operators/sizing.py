"""Row numbers and ranks over sets of any size, without a window over the whole set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skygauge.session import shared_dir

_PART, _ID, _BEFORE = "__part", "__id", "__before"


def _sorted_parts(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """``df`` range-sorted over tasks, with the number of the task and an ascending id; a checkpoint pins both."""
    shared_dir(df.sparkSession)
    placed = df.orderBy(*order_by).withColumn(_ID, F.monotonically_increasing_id()).checkpoint()
    return placed.withColumn(_PART, F.shiftright(_ID, 33))  # the id is (task << 33) + place in the task


def _with_rows_before(parts: DataFrame, weight: Column) -> DataFrame:
    """``_before``: the sum of ``weight`` over all tasks before the row's own. One row for each task is gathered, as
    many as there are shuffle partitions."""
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (parts.groupBy(_PART).agg(F.sum(weight).alias("__sum"))
               .select(_PART, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias(_BEFORE)))
    return parts.join(F.broadcast(offsets), _PART)


def number_rows(df: DataFrame, order_by: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in the order of ``order_by``, which must be unique.

    Rows are range-sorted, and each gets its place within its task plus the rows of the tasks before it.
    """
    parts = _sorted_parts(df, order_by)
    place = F.col(_ID).bitwiseAND(F.lit((1 << 33) - 1))
    return (_with_rows_before(parts, F.lit(1)).withColumn(name, F.col(_BEFORE) + place + F.lit(start))
            .select(*df.columns, name))


def percent_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the share of the other rows that have a smaller value of ``column``, 0 if there is one row only.

    Equal values share their rank, and NULL is smaller than any value, as in the window function of that name with
    nulls first. Values are counted before they are sorted, so a value that many rows have is one row; the sum of the rows
    before it is taken within its task, and added to that of the tasks before. ``df`` is read twice, so it has to
    give the same rows again.
    """
    values = df.groupBy(F.col(column).alias("__value")).agg(F.count("*").alias("__rows"))
    parts = _with_rows_before(_sorted_parts(values, [F.col("__value").asc_nulls_first()]), F.col("__rows"))
    within = Window.partitionBy(_PART).orderBy(_ID).rowsBetween(Window.unboundedPreceding, -1)
    ranks = parts.select("__value", (F.col(_BEFORE) + F.coalesce(F.sum("__rows").over(within), F.lit(0))).alias("__smaller"))
    total = values.agg(F.sum("__rows").alias("n")).scalar()
    others = F.greatest(total - 1, F.lit(1))
    return df.join(ranks, F.col(column).eqNullSafe(F.col("__value"))).select(*df.columns, (F.col("__smaller") / others).alias(name))

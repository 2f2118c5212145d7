"""A storage order that serves filters on several columns: values are cut into ranges, whose numbers' bits are mixed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def cut_points(rows: DataFrame, columns: Sequence[str], bits: int = 6) -> dict[str, list]:
    """For each column of numbers, days or times up to ``2 ** bits - 1`` values that cut the rows into ranges of about
    equal size, in order.

    One aggregation over all rows with sketches of bounded size; a value that holds many rows is listed once.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = rows.agg(*[F.percentile_approx(c, shares, 10_000).alias(f"cut{k}") for k, c in enumerate(columns)]).first()
    return {c: sorted(set(found[k] or [])) for k, c in enumerate(columns)}


def range_number(column: Column, points: Sequence) -> Column:
    """How many of the points are at most the value; 0 for NULL and for what lies below all."""
    if not points:
        return F.lit(0)
    at_most = F.filter(F.array(*[F.lit(p) for p in points]), lambda p: p <= column)
    return F.when(column.isNull(), 0).otherwise(F.size(at_most))


def interleaved(numbers: Sequence[Column], bits: int = 6) -> Column:
    """The numbers' lowest ``bits`` bits mixed into one: the first bit of each, then the second of each, and so on.

    Rows that are near in this order are near in every one of the columns. At most 63 bits in all.
    """
    if not 0 < bits * len(numbers) <= 63:
        raise ValueError("between 1 and 63 bits in all")
    count = len(numbers)
    moved = [F.shiftleft(F.shiftright(n.cast("long"), bit).bitwiseAND(F.lit(1)), bit * count + count - 1 - k)
             for k, n in enumerate(numbers) for bit in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), moved)


def text_number(column: Column) -> Column:
    """The first six bytes of a text as a number, in the order of the texts; texts that begin alike share it."""
    first = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
    return F.conv(first, 16, 10).cast("long")


def curve_key(rows: DataFrame, texts: Sequence[str], ordered: Sequence[str], bits: int = 6) -> Column:
    """The sort key of rows by texts and by numbers, days or times; one pass over the rows finds the ranges."""
    values = {c: text_number(F.col(c)) for c in texts} | {c: F.col(c) for c in ordered}
    points = cut_points(rows.select(*[v.alias(c) for c, v in values.items()]), list(values), bits)
    return interleaved([range_number(v, points[c]) for c, v in values.items()], bits)


def write_along_curve(rows: DataFrame, path: str, texts: Sequence[str], ordered: Sequence[str], files: int,
                      bits: int = 6, group_bytes: int = 16 << 20) -> None:
    """Replace a table by the rows in the order of :func:`curve_key`, range-partitioned into ``files`` files.

    A range of the key is a box in the columns, so each file and row group has narrow bounds in all of them and a
    filter on any of them skips most. Instants have such bounds only if ``spark.sql.parquet.outputTimestampType`` is
    TIMESTAMP_MICROS; times without zone always have them. A hot value's rows have different keys by the other columns, so they are split.
    """
    keyed = rows.withColumn("__curve", curve_key(rows, texts, ordered, bits))
    spread = keyed.repartitionByRange(files, "__curve", *ordered).sortWithinPartitions("__curve", *texts, *ordered)
    (spread.drop("__curve").write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path))

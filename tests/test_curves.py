import datetime as dt
import glob
import itertools

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from skygauge.operators.curves import cut_points, interleaved, range_number, write_along_curve


def plain(numbers, bits):
    out = 0
    for bit in reversed(range(bits)):
        for n in numbers:
            out = out * 2 + (n >> bit & 1)
    return out


def test_mixed_bits(spark):
    data = list(itertools.product(range(8), range(0, 8, 3), range(0, 8, 2)))
    found = spark.createDataFrame(data, "a INT, b INT, c INT").select(
        "a", "b", "c", interleaved([F.col("a"), F.col("b"), F.col("c")], 3).alias("z")).collect()
    assert all(r.z == plain((r.a, r.b, r.c), 3) for r in found) and len({r.z for r in found}) == len(data)
    for numbers, bits in (([], 3), ([F.lit(1)] * 8, 8)):
        with pytest.raises(ValueError):
            interleaved(numbers, bits)


def test_ranges_are_of_equal_size(spark):
    rows = spark.range(8_000).select((F.col("id") * F.col("id")).alias("v"), F.lit(None).cast("long").alias("n"))
    points = cut_points(rows, ["v", "n"], 3)
    assert len(points["v"]) == 7 and points["n"] == []
    sizes = rows.groupBy(range_number(F.col("v"), points["v"]).alias("r")).count().collect()
    assert sorted(r.r for r in sizes) == list(range(8)) and all(abs(r["count"] - 1_000) < 20 for r in sizes)
    assert {r[0] for r in rows.select(range_number(F.col("n"), points["v"])).distinct().collect()} == {0}


def bounds(path, column):
    out = []
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for k in range(meta.num_row_groups):
            group = meta.row_group(k)
            stats = next(group.column(c).statistics for c in range(group.num_columns) if group.column(c).path_in_schema == column)
            out.append((stats.min, stats.max))
    return out


def skipped(path, column, lo, hi):
    spans = bounds(path, column)
    return sum(b < lo or a > hi for a, b in spans) / len(spans)


def test_filters_on_region_and_on_time_skip_files(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = spark.range(40_000).select(  # one region has a third of all rows
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 40)).alias("region"),
        (F.lit(start) + F.make_dt_interval(F.lit(0), (F.col("id") * 7919 % 8_760).cast("int"))).cast("timestamp_ntz").alias("time"), "id")
    curve, by_time = str(tmp_path / "curve"), str(tmp_path / "time")
    write_along_curve(rows, curve, ["region"], ["time"], 32)
    rows.repartitionByRange(32, "time").sortWithinPartitions("time").write.parquet(by_time)
    assert spark.read.parquet(curve).exceptAll(rows).count() == 0 and spark.read.parquet(curve).count() == 40_000
    assert skipped(by_time, "region", "r7", "r7") == 0 and skipped(curve, "region", "r7", "r7") >= 0.5
    week = dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 8)
    assert skipped(curve, "time", *week) >= 0.5
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{curve}/*.parquet")]
    assert max(sizes) < 3 * 40_000 / 32  # the hot region is spread over files
    write_along_curve(rows.limit(0), str(tmp_path / "none"), ["region"], ["time"], 4)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from skygauge.operators import sizing
from skygauge.operators.keyed import append_columns, latest_per_key, merge_frames, missed_rows, newer_than
from skygauge.sources import tables
from skygauge.sources.tables import (drop_periods_before, overwrite_table, read_if_exists, read_table,
                                     table_exists, upsert_table)

ROW = "day DATE, place STRING, loaded INT, v DOUBLE"


def rows(df):
    return sorted(map(tuple, df.drop("period").collect()), key=repr)


def frame(spark, data, ddl=ROW):
    return spark.createDataFrame(data, ddl)


def d(n, month=1):
    return dt.date(2024, month, n)


def test_latest_per_key_breaks_ties_by_all_columns(spark):
    df = frame(spark, [(d(1), "A", 1, 5.0), (d(1), "A", 2, 1.0), (d(1), "A", 2, 3.0), (d(1), "B", 1, None)])
    assert rows(latest_per_key(df, ["day", "place"], ["loaded"])) == [
        (d(1), "A", 2, 3.0), (d(1), "B", 1, None)]


def test_latest_per_key_with_one_hot_key(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    result = latest_per_key(df, ["k"], ["id"])
    assert result.count() == 20001
    assert result.filter("k = 0").first()["id"] == 29997


def test_merge_and_new_columns(spark):
    old = frame(spark, [(d(1), "A", 1, 1.0), (d(2), "A", 1, 2.0)])
    new = frame(spark, [(d(2), "A", 2, 9.0, "x"), (d(3), "A", 2, 3.0, "y")], ROW + ", note STRING")
    merged = merge_frames(old, new, ["day", "place"])
    assert merged.columns == ["day", "place", "loaded", "v", "note"]
    assert rows(merged) == [(d(1), "A", 1, 1.0, None), (d(2), "A", 2, 9.0, "x"), (d(3), "A", 2, 3.0, "y")]
    assert rows(append_columns(old.drop("v"), old.limit(0))) == [(d(1), "A", 1, None), (d(2), "A", 1, None)]


def test_high_water_mark(spark, ntz):
    source = ntz([("2024-01-01 00:00:00", 1), ("2024-01-02 00:00:00", 2), (None, 3)], "t TIMESTAMP_NTZ, n INT")
    target = ntz([("2024-01-01 00:00:00",)], "t TIMESTAMP_NTZ")
    assert [r.n for r in newer_than(source, target, "t").collect()] == [2]
    assert newer_than(source, target.limit(0), "t").count() == 2      # the epoch stands for an empty target
    assert newer_than(source, None, "t").count() == 3
    assert [r.n for r in missed_rows(source, target, ["t"]).collect()] == [2, 3]


def test_high_water_mark_reaches_the_scan(spark, tmp_path, ntz):
    path = str(tmp_path / "t")
    ntz([("2024-01-01 00:00:00", 1)], "t TIMESTAMP_NTZ, n INT").write.parquet(path)
    stored = spark.read.parquet(path)
    plan = newer_than(stored, stored, "t")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert any("Subquery" in line or "subquery" in line for line in scans)


UPDATES = st.lists(st.tuples(st.integers(1, 4), st.sampled_from("AB"), st.floats(0, 9)), min_size=1, max_size=8)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches=st.lists(UPDATES, min_size=1, max_size=3))
def test_upsert_properties(spark, tmp_path_factory, batches):
    """A repeated batch changes nothing, batches may come in any order, and the newest row of each key stays."""
    folder = tmp_path_factory.mktemp("upsert")
    path, reverse = str(folder / "t"), str(folder / "r")
    frames = [frame(spark, [(d(n, month=1 + n % 3), p, load, v) for n, p, v in batch])
              for load, batch in enumerate(batches)]
    for f in frames:
        upsert_table(f, path, ["day", "place"], ["loaded"], "day")
        upsert_table(f, path, ["day", "place"], ["loaded"], "day")
    for f in reversed(frames):
        upsert_table(f, reverse, ["day", "place"], ["loaded"], "day")
    assert rows(read_table(spark, reverse)) == rows(read_table(spark, path))
    everything = frames[0]
    for f in frames[1:]:
        everything = everything.union(f)
    stored = read_table(spark, path)
    assert rows(stored) == rows(latest_per_key(everything, ["day", "place"], ["loaded"]))
    assert stored.count() == stored.select("day", "place").distinct().count()


def test_upsert_touches_only_its_periods(spark, tmp_path):
    path = tmp_path / "t"
    upsert_table(frame(spark, [(d(1), "A", 1, 1.0), (d(1, 2), "A", 1, 2.0)]), str(path), ["day", "place"], ["loaded"], "day")
    before = sorted(p.name for p in (path / "period=2024-01-01").glob("*.parquet"))
    upsert_table(frame(spark, [(d(1, 2), "A", 2, 9.0)]), str(path), ["day", "place"], ["loaded"], "day")
    assert sorted(p.name for p in (path / "period=2024-01-01").glob("*.parquet")) == before
    assert rows(read_table(spark, str(path))) == [(d(1), "A", 1, 1.0), (d(1, 2), "A", 2, 9.0)]


def test_an_older_load_does_not_replace_a_newer_row(spark, tmp_path):
    path = str(tmp_path / "t")
    for load, v in ((2, 5.0), (1, 9.0), (2, 6.0)):
        upsert_table(frame(spark, [(d(1), "A", load, v)]), path, ["day", "place"], ["loaded"], "day")
    assert rows(read_table(spark, path)) == [(d(1), "A", 2, 6.0)]


def test_upsert_adds_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(frame(spark, [(d(1), "A", 1, 1.0), (d(1, 2), "A", 1, 2.0)]), path, ["day", "place"], ["loaded"], "day")
    wider = frame(spark, [(d(2), "A", 2, 9.0, "x")], ROW + ", note STRING")
    upsert_table(wider, path, ["day", "place"], ["loaded"], "day")
    assert rows(read_table(spark, path).select("day", "note")) == [
        (d(1), None), (d(2), "x"), (d(1, 2), None)]
    upsert_table(frame(spark, [(d(2), "A", 3, 1.0)]), path, ["day", "place"], ["loaded"], "day")
    assert "note" in read_table(spark, path).columns


def test_upsert_of_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = frame(spark, [])
    upsert_table(empty, path, ["day", "place"], ["loaded"], "day")
    assert not table_exists(spark, path) and read_if_exists(spark, path) is None
    upsert_table(frame(spark, [(d(1), "A", 1, 1.0)]), path, ["day", "place"], ["loaded"], "day")
    upsert_table(empty, path, ["day", "place"], ["loaded"], "day")
    assert read_table(spark, path).count() == 1


@pytest.mark.parametrize("moved", [0, 1])
def test_upsert_completes_a_write_that_was_cut_off(spark, tmp_path, monkeypatch, moved):
    path = str(tmp_path / "t")
    upsert_table(frame(spark, [(d(1), "A", 1, 1.0), (d(1, 2), "A", 1, 2.0)]), path, ["day", "place"], ["loaded"], "day")
    real, calls = tables._move, []

    def fail_after(*args):
        if len(calls) == moved:
            raise OSError("the driver is gone")
        calls.append(args)
        real(*args)
    monkeypatch.setattr(tables, "_move", fail_after)
    with pytest.raises(OSError):
        upsert_table(frame(spark, [(d(1), "A", 2, 8.0), (d(1, 2), "A", 2, 9.0)]), path, ["day", "place"], ["loaded"], "day")
    monkeypatch.setattr(tables, "_move", real)
    assert rows(read_if_exists(spark, path)) == [(d(1), "A", 2, 8.0), (d(1, 2), "A", 2, 9.0)]


def test_overwrite_from_itself_and_recovery(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.range(3), path)
    overwrite_table(spark.read.parquet(path).filter("id > 0"), path)
    assert sorted(r.id for r in read_table(spark, path).collect()) == [1, 2]
    spark.range(7).write.parquet(path + "__pending")          # written in full, but not yet moved
    assert read_if_exists(spark, path).count() == 7


def test_retention_drops_day_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(frame(spark, [(d(n), "A", 1, 1.0) for n in range(1, 6)]), path, ["day", "place"], ["loaded"], "day", grain="day")
    assert drop_periods_before(spark, path, d(3)) == 2
    assert [r[0] for r in rows(read_table(spark, path).select("day"))] == [d(3), d(4), d(5)]


def test_number_rows(spark):
    names = spark.range(500).select(F.format_string("n%05d", F.col("id") * 7 % 500).alias("name")).repartition(7)
    numbered = sizing.number_rows(names, ["name"], "key", start=5)
    assert [(r["name"], r["key"]) for r in numbered.orderBy("name").collect()] == [
        (f"n{i:05d}", i + 5) for i in range(500)]
    assert sizing.number_rows(names.limit(0), ["name"], "key").collect() == []


def test_percent_rank_equals_the_window_function(spark):
    values = spark.range(600).select("id", F.when(F.col("id") % 50 != 7, F.col("id") * 37 % 91 / 3.0).alias("v")).repartition(5)
    ranked = sizing.percent_rank(values, "v", "rank")
    window = values.withColumn("rank", F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_first())))
    assert {tuple(r) for r in ranked.collect()} == {tuple(r) for r in window.collect()}
    one = sizing.percent_rank(values.filter("id = 3"), "v", "rank").collect()
    assert [r["rank"] for r in one] == [0.0]
    assert sizing.percent_rank(values.limit(0), "v", "rank").collect() == []
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("__part" in line for line in windows)  # none over all rows


@pytest.mark.parametrize("row", [(None, "A", 2, 1.0), (d(2), None, 2, 1.0)])
def test_upsert_refuses_rows_without_their_key(spark, tmp_path, row):
    path = str(tmp_path / "t")
    upsert_table(frame(spark, [(d(1), "A", 1, 1.0)]), path, ["day", "place"], ["loaded"], "day")
    with pytest.raises(Exception, match="a part of the key"):
        upsert_table(frame(spark, [row, (d(1), "A", 2, 5.0)]), path, ["day", "place"], ["loaded"], "day")
    assert rows(read_if_exists(spark, path)) == [(d(1), "A", 1, 1.0)]


def test_the_merge_shuffles_once_and_reads_each_side_once(spark, tmp_path):
    stored, update = str(tmp_path / "stored"), str(tmp_path / "update")
    frame(spark, [(d(1), "A", 2, 5.0), (d(2), "A", 1, 2.0)]).write.parquet(stored)
    frame(spark, [(d(1), "A", 1, 9.0), (d(2), "A", 1, 7.0), (d(3), "B", 1, 3.0)]).write.parquet(update)
    result = tables.merged(spark.read.parquet(stored), spark.read.parquet(update), ["day", "place"], ["loaded"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 2 and "Join" not in plan
    assert rows(result) == [(d(1), "A", 2, 5.0), (d(2), "A", 1, 7.0), (d(3), "B", 1, 3.0)]


def test_a_stored_table_without_the_order_gives_way(spark):
    old = frame(spark, [(d(1), "A", 9.0), (d(2), "A", 4.0)], "day DATE, place STRING, v DOUBLE")
    new = frame(spark, [(d(1), "A", None, 1.0)])
    assert rows(tables.merged(old, new, ["day", "place"], ["loaded"]).select("day", "place", "loaded", "v")) == [
        (d(1), "A", None, 1.0), (d(2), "A", None, 4.0)]

import datetime as dt
import glob
import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from skygauge.operators.keyed import latest_per_key
from skygauge.sources.deltas import changed_between, compact_deltas, open_days, read_merged, upsert_delta
from skygauge.sources.tables import folder_names

ROW = "day DATE, place STRING, loaded INT, v DOUBLE"
KEYS, ORDER = ["day", "place"], ["loaded"]


def d(n):
    return dt.date(2024, 1, n)


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/period=*/*/*.parquet")}


def load(spark, path, number, data, ddl=ROW):
    upsert_delta(spark.createDataFrame(data, ddl), path, number, KEYS, ORDER, "day")


def rows(spark, path):
    return sorted((tuple(r) for r in read_merged(spark, path, KEYS, ORDER).drop("period").collect()), key=repr)


def test_a_late_row_writes_one_file(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, 0, [(d(n), p, 1, 1.0) for n in (1, 2, 3) for p in "ABC"])
    before = files(path)
    load(spark, path, 1, [(d(1), "A", 2, 9.0)])
    after = files(path)
    assert len(after) == len(before) + 1 and {f: after[f] for f in before} == before
    assert open_days(spark, path) == [d(1)]
    assert rows(spark, path) == sorted([(d(n), p, 1, 1.0) for n in (1, 2, 3) for p in "ABC" if (n, p) != (1, "A")]
                                       + [(d(1), "A", 2, 9.0)], key=repr)
    load(spark, path, 1, [(d(1), "A", 2, 9.0)])  # the same load again
    assert len(files(path)) == len(after) and len(rows(spark, path)) == 9


def test_older_rows_and_rows_of_equal_order(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, 0, [(d(1), "A", 5, 1.0), (d(1), "B", 5, 9.0), (d(1), "B", 4, 2.0)])
    load(spark, path, 1, [(d(1), "A", 4, 2.0), (d(1), "B", 5, 3.0)])
    wanted = [(d(1), "A", 5, 1.0), (d(1), "B", 5, 3.0)]  # an older one gives way, of equal ones the later load counts
    assert rows(spark, path) == wanted
    assert compact_deltas(spark, path, "2024-01-02", KEYS, ORDER) == 1
    assert rows(spark, path) == wanted and open_days(spark, path) == []
    load(spark, path, 2, [(d(1), "A", 5, 7.0)])
    assert rows(spark, path) == [(d(1), "A", 5, 7.0), wanted[1]]
    assert compact_deltas(spark, path, "2024-01-02", KEYS, ORDER) == 1
    assert rows(spark, path) == [(d(1), "A", 5, 7.0), wanted[1]]


def test_new_columns_and_rows_without_key(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, 0, [(d(1), "A", 1, 1.0), (d(2), "A", 1, 1.0)])
    load(spark, path, 1, [(d(1), "B", 1, 2.0, "x")], ROW + ", note STRING")
    assert rows(spark, path) == [(d(1), "A", 1, 1.0, None), (d(1), "B", 1, 2.0, "x"), (d(2), "A", 1, 1.0, None)]
    for bad in ((None, "A", 1, 1.0), (d(1), None, 1, 1.0)):
        with pytest.raises(Exception, match="part of the key"):
            load(spark, path, 2, [bad])
    with pytest.raises(ValueError):
        load(spark, path, -1, [])
    load(spark, path, 3, [])
    assert len(rows(spark, path)) == 3


def test_rows_of_a_load(spark, tmp_path):
    path = str(tmp_path / "t")
    for number in range(3):
        load(spark, path, number, [(d(1 + number), "A", 1, float(number)), (d(1), "Z", number, 0.0)])
    assert sorted(r.loaded for r in changed_between(spark, path, 1, 2).filter("place = 'Z'").collect()) == [1, 2]
    with pytest.raises(ValueError):
        changed_between(spark, str(tmp_path / "none"), 0, 1)


def test_only_open_days_are_shuffled_and_filters_reach_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, 0, [(d(n), "A", 1, 1.0) for n in range(1, 9)])
    closed = read_merged(spark, path, KEYS, ORDER)
    assert "Exchange" not in closed._jdf.queryExecution().executedPlan().toString()
    load(spark, path, 1, [(d(2), "A", 2, 2.0)])
    one = read_merged(spark, path, KEYS, ORDER).filter((F.col("period") == d(2)) & (F.col("place") == "A"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("EqualTo(place,A)" in line and "2024-01-02" in line for line in scans)
    assert [r.v for r in one.collect()] == [2.0]


def test_compaction_goes_on_after_a_stop(spark, tmp_path, monkeypatch):
    from skygauge.sources import tables
    path = str(tmp_path / "t")
    for number in range(3):
        load(spark, path, number, [(d(n), "A", number, float(number)) for n in (1, 2, 9)])
    wanted = rows(spark, path)
    calls = []

    def stop(spark, where):
        calls.append(where)
        if len(calls) > 1:
            raise RuntimeError("stopped")
        remove(spark, where)

    remove = tables.remove_path
    with monkeypatch.context() as patched:
        patched.setattr(tables, "remove_path", stop)
        with pytest.raises(RuntimeError):
            compact_deltas(spark, path, "2024-01-05", KEYS, ORDER)
    compact_deltas(spark, path, "2024-01-05", KEYS, ORDER)
    assert rows(spark, path) == wanted and open_days(spark, path) == [d(9)]
    assert len([n for n in folder_names(spark, f"{path}/period=2024-01-01") if n.startswith("batch_id=")]) == 1


change = st.tuples(st.integers(1, 3), st.sampled_from("AB"), st.integers(0, 2), st.integers(0, 3))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(change, max_size=5), min_size=1, max_size=3), st.integers(0, 2))
def test_any_loads_equal_one_pass_over_all(spark, tmp_path_factory, loads, compacted):
    path = str(tmp_path_factory.mktemp("any") / "t")
    every = []
    for number, data in enumerate(loads):
        data = [(d(n), p, loaded, float(v)) for n, p, loaded, v in data]
        load(spark, path, number, data)
        every += [(number, *r) for r in data]
        if number == compacted:
            compact_deltas(spark, path, "2024-01-03", KEYS, ORDER)
    whole = latest_per_key(spark.createDataFrame(every, "number INT, " + ROW), KEYS, [*ORDER, "number"]).drop("number")
    assert rows(spark, path) == sorted((tuple(r) for r in whole.select("day", "place", "loaded", "v").collect()), key=repr)

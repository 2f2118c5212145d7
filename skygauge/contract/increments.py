"""Queries over stored silver and gold tables that grow by two runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge.contract import sqltext as S
from skygauge.contract.checks import report_sql
from skygauge.contract.layers import names_of
from skygauge.contract.registry import query
from skygauge.contract.standins import RUN_TS, bronze
from skygauge.functions.times import ts_literal
from skygauge.plans import batch, gold
from skygauge.plans.silver import silver, silver_keys
from skygauge.schemas import SOURCES, TIME_COLUMN
from skygauge.session import scratch_path
from skygauge.sources.changes import note_changes
from skygauge.sources.tables import overwrite_table, read_table, upsert_table

_SOURCE = "weather"
#: What is loaded from here on belongs to the second run.
_SECOND_RUN, _SECOND_TS = "2000-06-01 00:00:00", "2030-01-02 00:00:00"


def _two_runs(spark: SparkSession, sf_dir: str, after_run=lambda warehouse: None) -> str:
    """A warehouse with the weather's silver, dimensions and fact after two runs; ``after_run`` is called after each."""
    house = scratch_path(spark, "house")
    overwrite_table(gold.dim_date(spark, RUN_TS), batch.gold_path(house, "dim_date"))
    overwrite_table(gold.dim_governorate(names_of(spark, sf_dir, *SOURCES), RUN_TS), batch.gold_path(house, "dim_governorate"))
    rows, path = bronze(spark, sf_dir, _SOURCE), batch.silver_path(house, _SOURCE)
    second = F.col("load_timestamp") >= ts_literal(_SECOND_RUN)
    for run_ts, loaded in ((RUN_TS, rows.filter(~second)), (_SECOND_TS, rows.filter(second))):
        new = silver(loaded, _SOURCE, run_ts)
        note_changes(spark, path, upsert_table(new, path, silver_keys(_SOURCE), ["load_timestamp"], TIME_COLUMN[_SOURCE]))
        batch.build_facts(spark, house, run_ts)
        after_run(house)
    return house


@query(f"""WITH {S.gold_cte(_SOURCE)} SELECT * EXCLUDE (transform_timestamp, created_at),
    CASE WHEN load_timestamp < TIMESTAMP '{_SECOND_RUN}' THEN 1 ELSE 2 END AS run FROM fact_{_SOURCE}""")
def fact_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored fact after two runs, the second of which has read the changed periods of silver only."""
    house = _two_runs(spark, sf_dir)
    run = F.when(F.col("transform_timestamp") == ts_literal(RUN_TS), 1).otherwise(2).alias("run")
    fact = read_table(spark, batch.gold_path(house, f"fact_{_SOURCE}"))
    return fact.select("*", run).drop("transform_timestamp", "created_at", "period")


@query(f"""SELECT * FROM ({report_sql()}) WHERE "table" IN ('dim_date', 'dim_governorate', 'fact_{_SOURCE}')""")
def dq_report_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report after two runs: the fact's results by period, those of the second run's periods computed anew."""
    house = _two_runs(spark, sf_dir, lambda warehouse: batch.check_gold(spark, warehouse))
    return spark.read.parquet(f"{house}/audit/report")

"""Per-day state of the interaction fact."""

import json
import re
import uuid
from datetime import date

from tests.conftest import LOG_SCHEMA, SF001, rows
from watchfold.operators import daily
from watchfold.operators import interaction as it
from watchfold.plans import jobs
from watchfold.plans.warehouse import DAILY_TABLE, INTERACTION_TABLE, Warehouse
from watchfold.sources.fixtures import DriverTables, log_content_fixture


def test_month_from_days_is_month_from_logs(spark):
    logs = log_content_fixture(DriverTables(spark, SF001))
    state = daily.daily_state(logs)
    assert state.columns == daily.STATE_COLUMNS
    assert rows(daily.fact_from_daily(state)) == rows(it.fact_interaction(logs))


def test_defined_cases(spark):
    d = date(2024, 1, 5)
    logs = spark.createDataFrame([
        ("C1", "M", "VOD", None, d), ("C1", "M", "VOD", 5, d), ("C1", "M", None, 3, d), ("C2", "M", "VOD", None, d),
        ("C3", "M", "VOD", 0, d), ("0", "M", "VOD", 5, d), ("", "M", "VOD", 5, d), (None, "M", "VOD", 5, d),
        ("C4", "M", "SPORT", 2, None)], LOG_SCHEMA)
    got = {r.Contract: r for r in daily.daily_state(logs).collect()}
    assert set(got) == {"C1", "C2", "C3"}                          # real contracts of a known day
    assert (got["C1"].Movies, got["C1"].Error, got["C1"].log_rows) == (5, 3, 3)
    assert got["C2"].Movies is None and got["C3"].Movies == 0
    assert rows(daily.fact_from_daily(daily.daily_state(logs)), "Contract", "TotalDevices", "Active_Days") == [("C1", 3, 1)]
    assert daily.daily_state(logs.limit(0)).count() == 0
    both = daily.daily_state(logs).union(daily.daily_state(logs))   # two loads of a day add up
    assert rows(daily.fact_from_daily(both), "Movies", "TotalDevices", "Active_Days") == [(10, 6, 1)]


def line(contract, app="VOD", seconds=5):
    return json.dumps({"_source": {"Contract": contract, "Mac": "M", "AppName": app, "TotalDuration": seconds}})


def test_one_day_is_reloaded(spark, tmp_path):
    warehouse = Warehouse(spark, schema=f"wf_daily_{uuid.uuid4().hex[:8]}")
    warehouse.setup()
    days = {"20240130": [line("C1"), line("C2", "SPORT")], "20240131": [line("C1"), line("C1", "CHANNEL", 9)],
            "20240201": [line("C3")]}
    for day, lines in days.items():
        (tmp_path / f"{day}.json").write_text("\n".join(lines) + "\n")
    fact = jobs.run_daily_etl(spark, str(tmp_path), "20240130", "20240201", warehouse)
    assert rows(fact, "month_yyyymm", "Contract", "Movies", "Active_Days") == [
        ("202401", "C1", 10, 2), ("202401", "C2", 0, 1), ("202402", "C3", 5, 1)]
    before = {r.partition: loc for r in spark.sql(f"SHOW PARTITIONS {warehouse.name(DAILY_TABLE)}").collect()
              for loc in [place(spark, warehouse.name(DAILY_TABLE), r.partition)]}

    (tmp_path / "20240131.json").write_text(line("C1", seconds=1) + "\n")          # a corrected day
    fact = jobs.run_daily_etl(spark, str(tmp_path), "20240131", "20240131", warehouse)
    assert rows(fact, "month_yyyymm", "Contract", "Movies", "TV_Channel") == [
        ("202401", "C1", 6, 0), ("202401", "C2", 0, 0), ("202402", "C3", 5, 0)]
    after = {p: place(spark, warehouse.name(DAILY_TABLE), p) for p in before}
    assert [p for p in before if before[p] != after[p]] == ["log_date=2024-01-31"]   # one partition written

    (tmp_path / "20240201.json").write_text("")                                     # a day that has become empty
    fact = jobs.run_daily_etl(spark, str(tmp_path), "20240201", "20240201", warehouse)
    assert {r.month_yyyymm for r in fact.collect()} == {"202401"}

    (tmp_path / "20240129.json").write_text(line("C9") + "\n")                       # a late day
    fact = jobs.run_daily_etl(spark, str(tmp_path), "20240129", "20240129", warehouse)
    logs = [p for p in ("20240129", "20240130", "20240131")]
    whole = it.fact_interaction(jobs.read_watch_logs(spark, str(tmp_path), logs[0], logs[-1]))
    assert rows(fact) == rows(whole)
    assert len(warehouse.vacuum(DAILY_TABLE)) == 0 or warehouse.table(DAILY_TABLE).count() == 4
    spark.sql("USE default")


def place(spark, table, spec):
    name, value = spec.split("=", 1)
    rows_ = spark.sql(f"DESCRIBE FORMATTED {table} PARTITION ({name} = '{value}')").filter("col_name = 'Location'")
    return rows_.first().data_type


def test_only_the_months_days_are_read(spark):
    warehouse = Warehouse(spark, schema=f"wf_daily_{uuid.uuid4().hex[:8]}")
    spark.sql(f"CREATE SCHEMA {warehouse.schema}")
    logs = log_content_fixture(DriverTables(spark, SF001))
    days = [r.log_date for r in logs.select("log_date").distinct().collect()]
    warehouse.save_days(daily.daily_state(logs), days)
    frame = daily.fact_from_daily(daily.within(warehouse.table(DAILY_TABLE), [daily.month_span(2024, 2)]))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*log_date", plan)
    assert {r.month_yyyymm for r in frame.collect()} == {"202402"}
    assert warehouse.refresh_months([d for d in days if d.month == 2][:1]) == ["202402"]
    assert rows(warehouse.table(INTERACTION_TABLE)) == rows(frame)

import datetime as dt

import pytest

from tests.conftest import LOG_SCHEMA, SF001, rows
from watchfold.operators import interaction as it
from watchfold.sources.fixtures import DriverTables, log_content_fixture

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 2, 1)


def logs(spark, data):
    return spark.createDataFrame(data, LOG_SCHEMA)


def fact_by_contract(df):
    return {r.Contract: r.asDict() for r in df.collect()}


def test_placeholder_contracts_absent(spark):
    df = logs(spark, [(None, "m", "VOD", 10, D1), ("", "m", "VOD", 10, D1), ("0", "m", "VOD", 10, D1),
                      ("C1", "m", "VOD", 10, D1)])
    assert set(fact_by_contract(it.fact_interaction(df))) == {"C1"}
    assert set(fact_by_contract(it.fact_interaction_stepwise(df))) == {"C1"}


def test_contract_without_positive_total_is_absent(spark):
    df = logs(spark, [("C1", "m", "VOD", 0, D1), ("C1", "m", "RELAX", None, D1),
                      ("C2", "m", "VOD", 5, D1)])
    assert set(fact_by_contract(it.fact_interaction(df))) == {"C2"}


def test_unknown_app_only(spark):
    df = logs(spark, [("C1", "m", "XAPP", 30, D1), ("C1", "m", None, 5, D1)])
    row = fact_by_contract(it.fact_interaction(df))["C1"]
    assert [row[t] for t in ["Entertainment", "Kids", "Movies", "Sports", "TV_Channel"]] == [0] * 5
    assert row["Most_Watch"] == "Error" and row["customer_taste"] == "Error"
    assert list(it.fact_interaction(df).columns) == it.FACT_COLUMNS


def test_fixed_schema_without_sports(spark):
    df = logs(spark, [("C1", "m", "VOD", 10, D1)])
    for fact in (it.fact_interaction(df), it.fact_interaction_stepwise(df)):
        assert fact.columns == it.FACT_COLUMNS
        assert fact.first()["Sports"] == 0


def test_devices_rows_or_distinct(spark):
    df = logs(spark, [("C1", "m1", "VOD", 10, D1), ("C1", "m1", "VOD", 10, D1)])
    assert fact_by_contract(it.fact_interaction(df))["C1"]["TotalDevices"] == 2
    assert fact_by_contract(it.fact_interaction(df, distinct_devices=True))["C1"]["TotalDevices"] == 1
    assert rows(it.total_devices(df, distinct=True), "TotalDevices") == [(1,)]


def test_active_days(spark):
    df = logs(spark, [("C1", "m", "VOD", 1, D1)] * 3 + [("C1", "m", "VOD", 1, D2),
                                                        (None, "m", "VOD", 1, D1)])
    assert fact_by_contract(it.fact_interaction(df))["C1"]["Active_Days"] == 2
    one_pass = rows(it.active_days(df))
    from_daily = rows(it.active_days_from_daily(it.daily_active(df)))
    assert one_pass == from_daily == [("202401", None, 0), ("202401", "C1", 2)]


def test_most_watch_ties_and_taste_order(spark):
    df = logs(spark, [("C1", "m", "VOD", 10, D1), ("C1", "m", "RELAX", 10, D1),
                      ("C1", "m", "SPORT", 3, D1), ("C1", "m", "CHILD", -4, D1),
                      ("C2", "m", "CHANNEL", 5, D1), ("C2", "m", "XAPP", 9, D1)])
    fused = fact_by_contract(it.fact_interaction(df))
    assert fused["C1"]["Most_Watch"] == "Entertainment"
    assert fused["C1"]["customer_taste"] == "Entertainment,Movies,Sports"
    assert fused["C1"]["Kids"] == -4
    assert fused["C2"]["Most_Watch"] == "Error" and fused["C2"]["customer_taste"] == "Error,TV_Channel"
    assert rows(it.fact_interaction(df)) == rows(it.fact_interaction_stepwise(df))


def test_most_watch_null_totals_rank_last(spark):
    df = logs(spark, [("C1", "m", "VOD", None, D1), ("C1", "m", "RELAX", 0, D1)])
    mw = rows(it.most_watch(it.category_duration(df)), "Contract", "Most_Watch")
    assert mw == [("C1", "Entertainment")]


def test_months_backfill_and_fixed_month(spark):
    df = logs(spark, [("C1", "m", "VOD", 10, D1), ("C1", "m", "VOD", 20, D3)])
    by_month = rows(it.fact_interaction(df), "month_yyyymm", "Movies", "Active_Days")
    assert by_month == [("202401", 10, 1), ("202402", 20, 1)]
    fixed = rows(it.fact_interaction(df, month="202401"), "month_yyyymm", "Movies", "Active_Days")
    assert fixed == [("202401", 30, 2)]
    masked = it.fact_interaction(df, month="202401", window=(D1, D3))
    assert rows(masked, "month_yyyymm", "Movies", "Active_Days") == [("202401", 30, 2)]


def test_active_days_mask_edges(spark):
    days = [dt.date(2024, 1, d) for d in (1, 15, 31)] + [dt.date(2024, 2, 29), dt.date(2024, 2, 29)]
    df = logs(spark, [("C1", "m", "VOD", 1, d) for d in days])
    assert rows(it.fact_interaction(df), "month_yyyymm", "Active_Days") == [("202401", 3), ("202402", 1)]
    long_window = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))     # a mask for each month
    assert rows(it.fact_interaction(df, month="202401", window=long_window), "Active_Days") == [(4,)]
    short_window = (dt.date(2024, 1, 1), dt.date(2024, 2, 29))
    assert rows(it.fact_interaction(df, month="202401", window=short_window), "Active_Days") == [(4,)]


def test_day_outside_the_window_is_an_error_not_another_day(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 3, 5)]
    df = logs(spark, [("C1", "m", "VOD", 1, d) for d in days])
    with pytest.raises(Exception, match="log_date outside"):
        it.fact_interaction(df, month="202401", window=(dt.date(2024, 1, 1), dt.date(2024, 2, 29))).collect()
    whole = it.fact_interaction(df, month="202401", window=(dt.date(2024, 1, 1), dt.date(2024, 3, 31)))
    assert rows(whole, "Active_Days") == [(3,)]
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_stepwise_reads_the_log_once(spark):
    lc = log_content_fixture(DriverTables(spark, SF001))
    stepwise = it.fact_interaction_stepwise(lc)
    stepwise.collect()
    plan = stepwise._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 or "ReusedExchange" in plan


def test_pivot_keeps_error_only_contract(spark):
    df = logs(spark, [("C1", "m", "XAPP", 10, D1)])
    stats = it.contract_statistics(it.category_duration(df)).collect()
    assert len(stats) == 1 and stats[0]["Movies"] == 0


@pytest.mark.parametrize("month", [None, "202401"])
def test_fused_equals_stepwise_on_fixture(spark, month):
    lc = log_content_fixture(DriverTables(spark, SF001))
    fused, stepwise = it.fact_interaction(lc, month), it.fact_interaction_stepwise(lc, month)
    assert fused.columns == stepwise.columns
    assert rows(fused) == rows(stepwise)
    assert len(rows(fused)) > 90


def test_fused_plan_has_one_exchange(spark):
    lc = log_content_fixture(DriverTables(spark, SF001))
    plan = it.fact_interaction(lc)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_hot_contract_with_a_third_of_rows(spark):
    """One contract holds a third of all rows: same result as the step-by-step
    form, and the plan still combines map-side before its single exchange."""
    from pyspark.sql import functions as F
    apps = ["VOD", "RELAX", "CHILD", "SPORT", "CHANNEL", "XAPP"]
    base = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 997).cast("string")))
         .alias("Contract"),
        F.concat(F.lit("m"), (F.col("id") % 7).cast("string")).alias("Mac"),
        F.element_at(F.array(*[F.lit(a) for a in apps]), (F.col("id") % 6 + 1).cast("int")).alias("AppName"),
        (F.col("id") % 50).alias("TotalDuration"),
        F.date_add(F.lit(D1), (F.col("id") % 31).cast("int")).alias("log_date"))
    fused = it.fact_interaction(base)
    assert rows(fused) == rows(it.fact_interaction_stepwise(base))
    hot = fact_by_contract(fused)["HOT"]
    assert hot["TotalDevices"] == 10000 and hot["Active_Days"] == 31
    plan = it.fact_interaction(base)._jdf.queryExecution().executedPlan().toString()   # not yet run
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") == 1

"""Shapes of executed plans that the design rests on."""

import re

from tests.conftest import SF001
from watchfold.operators import analytics as an
from watchfold.operators import interaction as it
from watchfold.sources.fixtures import DriverTables, log_content_fixture


def executed(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_program_stats_keep_one_row_per_contract(spark):
    fact = it.fact_interaction(log_content_fixture(DriverTables(spark, SF001)))
    plan = executed(an.program_duration_stats(fact))
    assert "Expand" not in plan
    # logs by (month, contract), then one row a month and task
    assert [m.split(", ")[0] for m in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)].count("month_yyyymm") <= 2
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_top10_reads_one_program_column(spark):
    """The program's name is folded into a column before the scan; an unknown one reads no program at all."""
    import uuid

    from watchfold.plans.warehouse import Warehouse
    warehouse = Warehouse(spark, schema=f"wf_{uuid.uuid4().hex[:8]}")
    warehouse.setup()
    warehouse.save_interaction_fact(it.fact_interaction(log_content_fixture(DriverTables(spark, SF001))))
    warehouse.create_top10_function()

    def read(frame):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        return re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    stored = warehouse.table("fact_monthly_customer_interaction")
    assert read(warehouse.top10(" TV channel ")) == ["Contract:string,TV_Channel:bigint"]
    assert read(warehouse.top10("kids", "202401")) == ["Contract:string,Kids:bigint"]
    assert read(an.top_contracts(stored, "movies", month="202401")) == ["Contract:string,Movies:bigint"]
    unknown = warehouse.top10("zzz")
    assert read(unknown) == ["Contract:string"]
    assert [(r.Program, r.Duration) for r in unknown.collect()] == [("ZZZ", None)] * 10
    spark.sql("USE default")

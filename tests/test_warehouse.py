import os
import uuid

import pytest

from tests.conftest import rows
from watchfold.operators import analytics as an
from watchfold.operators.interaction import FACT_COLUMNS
from watchfold.plans import registry
from watchfold.plans import warehouse as wh
from tests.test_analytics import FACT, frow

BFACT = "user_id string, Previous_Genre string, Trending_Type string, month_yyyymm string"


def fact(spark, data):
    return spark.createDataFrame(data, FACT)


def test_path_sink_replaces_only_written_months(spark, tmp_path):
    path = str(tmp_path / "fact")
    april = fact(spark, [frow("C1", movies=1, month="202204")])
    may = fact(spark, [frow("C1", movies=2, month="202205"), frow("C2", movies=3, month="202205")])
    may_again = fact(spark, [frow("C1", movies=9, month="202205")])
    for f in (april, may, may_again):
        wh.save_fact_to_path(f, path)
    back = wh.read_fact_from_path(spark, path, FACT_COLUMNS, schema=april.schema)
    assert rows(back, "month_yyyymm", "Contract", "Movies") == [("202204", "C1", 1), ("202205", "C1", 9)]
    inferred = wh.read_fact_from_path(spark, path, FACT_COLUMNS)
    assert dict(inferred.dtypes)["month_yyyymm"] == "string"


def test_catalog_warehouse_end_to_end(spark):
    w = wh.Warehouse(spark, schema=f"wf_{uuid.uuid4().hex[:8]}")
    w.setup()
    f1 = fact(spark, [frow(f"C{i}", tv=i, movies=10 - i, days=i * 3, month="202204") for i in range(12)])
    f2 = fact(spark, [frow("C1", tv=5, month="202205")])
    w.save_interaction_fact(f1)
    w.save_interaction_fact(f2)
    w.save_interaction_fact(f2)                      # idempotent rerun of one month
    stored = w.table(wh.INTERACTION_TABLE)
    assert stored.count() == 13
    b = spark.createDataFrame([("u1", "Drama", "Changed", "202205"), ("u2", "Unchanged", "Unchanged", "202205")],
                              BFACT)
    w.save_behavior_fact(b)
    w.build_dimensions()
    assert w.table("dim_contract").count() == 12 and w.table("dim_user").count() == 2

    w.create_views()
    every = an.active_days_distribution(stored)
    view = spark.table(w.name("vw_contract_active_days_distribution"))
    assert [tuple(r) for r in view.collect()] == [tuple(r) for r in every.collect()]
    assert rows(spark.table(w.name("vw_program_duration_contract_stats"))) == rows(an.program_duration_stats(stored))
    assert rows(spark.table(w.name("vw_customer_taste_contract_devices"))) == rows(an.taste_distribution(stored))

    w.create_top10_function()
    top_sql = w.top10(" tv ", "202204").collect()
    top_df = an.top_contracts(stored, " tv ", 10, month="202204").drop("month_yyyymm").collect()
    assert [tuple(r) for r in top_sql] == [tuple(r) for r in top_df]
    assert len(top_sql) == 10 and top_sql[0].Contract == "C11" and top_sql[0].Program == "TV"

    assert w.top10("tv").count() == 10
    w.create_bridge_table()
    assert w.table(wh.BRIDGE_TABLE).count() == 0
    assert dict(w.table(wh.BRIDGE_TABLE).dtypes) == {
        "user_id": "string", "contract_id": "string", "start_date": "date", "end_date": "date",
        "is_primary": "boolean"}
    bridge = w.fill_bridge(seed=7)
    assert w.checks()["row_counts"].first().fact_interaction_rows == 13
    assert all(frame.columns for frame in w.report().values())
    assert bridge.count() > 0
    assert bridge.filter("is_primary").count() == bridge.select("contract_id").distinct().count()


class _StubContext:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, path):
        self._ckpt = path


class _StubConf:
    def get(self, key, default=None):
        return default


class _StubSession:
    def __init__(self, master, ckpt=None):
        self.sparkContext, self.conf = _StubContext(master, ckpt), _StubConf()


def test_new_columns_are_added_on_reload(spark):
    from pyspark.sql import functions as F
    w = wh.Warehouse(spark, schema=f"wf_{uuid.uuid4().hex[:8]}")
    w.setup()
    w.save_interaction_fact(fact(spark, [frow("C1", month="202204")]))
    w.save_interaction_fact(fact(spark, [frow("C1", month="202205")]).withColumn("Region", F.lit("north")))
    w.save_interaction_fact(fact(spark, [frow("C2", month="202206")]))
    assert rows(w.table(wh.INTERACTION_TABLE), "month_yyyymm", "Region") == [
        ("202204", None), ("202205", "north"), ("202206", None)]
    spark.sql("USE default")


def test_checkpoint_folder_rules():
    from watchfold.session import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(_StubSession("yarn", "hdfs://shared/ckpt")) == "hdfs://shared/ckpt"
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_StubSession("yarn"))               # a cluster must name a shared folder
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_StubSession("local-cluster[2,1,1024]"))
    assert ensure_checkpoint_dir(_StubSession("local[2]"))          # local sessions get a scratch folder


def new_warehouse(spark):
    w = wh.Warehouse(spark, schema=f"wf_{uuid.uuid4().hex[:8]}")
    w.setup()
    return w


def months_of(w, table=wh.INTERACTION_TABLE):
    return rows(w.table(table), "month_yyyymm", "Contract", "Movies")


def test_emptied_month_is_replaced(spark):
    w = new_warehouse(spark)
    w.save_interaction_fact(fact(spark, [frow("C1", movies=1, month="202204"), frow("C2", movies=2, month="202204"),
                                         frow("C1", movies=3, month="202205")]), ["202204", "202205"])
    empty = fact(spark, [])
    load = w.save_interaction_fact(empty, ["202204"])
    assert (load.rows, load.months, load.failed) == (0, [], [])
    assert months_of(w) == [("202205", "C1", 3)]
    w.save_interaction_fact(fact(spark, [frow("C9", movies=9, month="202204")]), ["202204"])      # and filled again
    assert months_of(w) == [("202204", "C9", 9), ("202205", "C1", 3)]
    w.save_interaction_fact(empty, ["202212"])                                  # a month that never was
    assert months_of(w) == [("202204", "C9", 9), ("202205", "C1", 3)]
    spark.sql("USE default")


def test_rows_of_a_month_not_named_publish_nothing(spark):
    w = new_warehouse(spark)
    w.save_interaction_fact(fact(spark, [frow("C1", movies=1, month="202204")]))
    both = fact(spark, [frow("C2", movies=2, month="202204"), frow("C2", movies=2, month="202205")])
    with pytest.raises(wh.CheckFailed, match="rows_of_other_months = 1"):
        w.save_interaction_fact(both, ["202204"])
    assert months_of(w) == [("202204", "C1", 1)]
    spark.sql("USE default")


def test_failing_check_leaves_the_old_month(spark):
    w = new_warehouse(spark)
    w.save_interaction_fact(fact(spark, [frow("C1", movies=1, month="202204")]), ["202204"])
    bad = fact(spark, [frow("C1", movies=5, month="202204"), frow(None, movies=5, month="202204"),
                       frow("0", movies=5, month="202204"), frow("", movies=5, month="202204")])
    with pytest.raises(wh.CheckFailed, match="null_keys = 1, placeholder_contracts = 2"):
        w.save_interaction_fact(bad, ["202204"])
    assert months_of(w) == [("202204", "C1", 1)]
    log = w.table(wh.LOAD_LOG)
    assert rows(log, "rows", "published") == [(1, True), (4, False)]
    assert log.filter("NOT published").first().failed == ["null_keys", "placeholder_contracts"]
    with pytest.raises(wh.CheckFailed, match="enough_rows = 0"):
        w.save_fact(fact(spark, []), wh.INTERACTION_TABLE, ["202204"], [wh.publish.at_least(1)])
    assert months_of(w) == [("202204", "C1", 1)]
    # nothing of the failed runs is left in the table's folder
    folder = wh.publish.table_folder(spark, w.name(wh.INTERACTION_TABLE))
    assert len(wh.publish.list_folders(spark, f"{folder}/_runs")) == 1
    spark.sql("USE default")


def test_reader_sees_the_old_month_or_the_new_one(spark):
    w = new_warehouse(spark)
    w.save_interaction_fact(fact(spark, [frow("C1", movies=1, month="202204")]), ["202204"])
    old = w.table(wh.INTERACTION_TABLE)                                         # planned before the swap
    assert old.count() == 1
    w.save_interaction_fact(fact(spark, [frow(f"C{i}", movies=2, month="202204") for i in range(5)]), ["202204"])
    assert old.count() in (1, 5)
    assert w.table(wh.INTERACTION_TABLE).count() == 5
    assert len(w.vacuum(wh.INTERACTION_TABLE)) == 1                             # the first run's folder
    assert w.table(wh.INTERACTION_TABLE).count() == 5 and w.vacuum(wh.INTERACTION_TABLE) == []
    spark.sql("USE default")


def test_checks_come_from_the_write_alone(spark):
    """The rows are computed once: metrics and rows are those of one job."""
    w, calls = new_warehouse(spark), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch
    source = fact(spark, [frow(f"C{i}", movies=2, month="202204") for i in range(7)])
    load = w.save_interaction_fact(source.mapInArrow(seen, source.schema), ["202204"])
    assert load.rows == 7 and load.metrics["null_keys"] == 0 and calls.value == 7
    spark.sql("USE default")


def test_path_sink_with_named_months(spark, tmp_path):
    path = str(tmp_path / "fact")
    both = fact(spark, [frow("C1", movies=1, month="202204"), frow("C1", movies=2, month="202205")])
    assert wh.save_fact_to_path(both, path, months=["202204", "202205"]).months == ["202204", "202205"]
    wh.save_fact_to_path(fact(spark, []), path, months=["202204", "202301"])
    back = wh.read_fact_from_path(spark, path, FACT_COLUMNS, schema=both.schema)
    assert rows(back, "month_yyyymm", "Movies") == [("202205", 2)]
    with pytest.raises(Exception, match="row of a month not named: 202204"):
        wh.save_fact_to_path(both, path, months=["202205"])
    back = wh.read_fact_from_path(spark, path, FACT_COLUMNS, schema=both.schema)
    assert rows(back, "month_yyyymm", "Movies") == [("202205", 2)]


def test_scratch_warehouse_beside_folders_of_an_earlier_session(spark):
    """The folders of a session outlive its catalog: two scratch warehouses have nothing in common."""
    from urllib.parse import urlparse
    base = urlparse(spark.conf.get("spark.sql.warehouse.dir")).path
    spark.sql("DROP SCHEMA IF EXISTS watchfold_scratch CASCADE")
    left = os.path.join(base, "watchfold_scratch.db", wh.LOAD_LOG)
    os.makedirs(left, exist_ok=True)
    open(os.path.join(left, "part-0.parquet"), "w").close()
    one, two = (registry._scratch_warehouse(spark) for _ in range(2))
    for w, n in ((one, 1), (two, 2)):
        w.save_interaction_fact(fact(spark, [frow(f"C{i}", movies=1, month="202204") for i in range(n)]))
        assert rows(w.table(wh.LOAD_LOG), "rows") == [(n,)]
    assert one.schema != two.schema and one.table(wh.INTERACTION_TABLE).count() == 1

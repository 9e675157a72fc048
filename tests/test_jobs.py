"""End to end: the driver's tables written out as the reference's files, then the jobs."""

import json
import os
import uuid

from pyspark.sql import functions as F

from tests.conftest import SF0001, rows
from watchfold.operators import behavior as bh
from watchfold.operators import interaction as it
from watchfold.plans import jobs
from watchfold.plans.warehouse import Warehouse
from watchfold.sources.files import write_genre_mapping
from watchfold.sources.fixtures import (
    DriverTables,
    genre_mapping_fixture,
    log_content_fixture,
    log_search_fixture,
)


def write_watch_logs(logs, folder):
    """One ``<yyyymmdd>.json`` per day with the nested ``_source`` payload."""
    by_day = {}
    for r in logs.collect():
        rec = {"_index": "history", "_source": {"Contract": r.Contract, "Mac": r.Mac,
                                                "AppName": r.AppName, "TotalDuration": r.TotalDuration}}
        by_day.setdefault(r.log_date.strftime("%Y%m%d"), []).append(rec)
    for day, recs in by_day.items():
        with open(os.path.join(folder, f"{day}.json"), "w") as fh:
            fh.write("\n".join(json.dumps(x) for x in recs) + "\n")
    return sorted(by_day)


def test_jobs_end_to_end(spark, tmp_path):
    tables = DriverTables(spark, SF0001)
    logs, searches, mapping = (log_content_fixture(tables), log_search_fixture(tables),
                               genre_mapping_fixture(tables))
    warehouse = Warehouse(spark, schema=f"wf_e2e_{uuid.uuid4().hex[:8]}")
    warehouse.setup()

    # interaction: 30 daily JSON files -> fact, tagged with the start month
    watch_dir = tmp_path / "log_content"
    watch_dir.mkdir()
    days = write_watch_logs(logs, str(watch_dir))
    fact_i = jobs.run_interaction_etl(spark, str(watch_dir), days[0], days[-1], warehouse,
                                      missing="skip")      # a day without any row has no file here
    assert rows(fact_i) == rows(it.fact_interaction(logs, month=days[0][:6]))

    # behaviour: a parquet tree with the month in the path + a genre CSV
    search_dir = str(tmp_path / "log_search")
    (searches.withColumn("month", (F.year("log_date") * 100 + F.month("log_date")).cast("string"))
     .drop("log_date").write.partitionBy("month").parquet(search_dir))
    mapping_dir = str(tmp_path / "genres_csv")
    write_genre_mapping(mapping, mapping_dir)
    backfill = bh.fact_behavior(searches, mapping)
    current = backfill.groupBy("month_yyyymm").count().orderBy(F.desc("count"), "month_yyyymm").first()[0]
    y, m = int(current[:4]), int(current[4:])
    previous = f"{y - 1}12" if m == 1 else f"{y}{m - 1:02d}"
    fact_b = jobs.run_behavior_etl(spark, search_dir, previous, current, mapping_dir, warehouse)
    assert fact_b.count() > 0
    assert rows(fact_b) == rows(backfill.filter(F.col("month_yyyymm") == current))

    # labelling: distinct top keywords of both months -> CSV with the closed genre list
    labels = jobs.run_labelling(spark, search_dir, previous, current, str(tmp_path / "labels_csv"))
    top = bh.most_searched(searches).filter(F.col("month_yyyymm").isin(previous, current))
    assert rows(labels, "most_searched") == rows(bh.distinct_programs(top))

    jobs.run_export(spark, search_dir, previous, current, str(tmp_path / "programs_csv"))
    assert jobs.load_labeller("watchfold.operators.labelling:rule_labeller")(["VTV3"]).count("TV Channel") == 1

    # SQL model on top of both facts
    jobs.run_model(warehouse, seed=5)
    for view in ("vw_contract_active_days_distribution", "vw_program_duration_contract_stats",
                 "vw_customer_taste_contract_devices"):
        assert spark.table(warehouse.name(view)).count() > 0
    assert warehouse.top10("tv", days[0][:6]).count() == 10
    bridge = warehouse.table("user_contract_details")
    assert bridge.filter("is_primary").count() == bridge.select("contract_id").distinct().count()


def test_reload_of_an_emptied_month(spark, tmp_path):
    """Both jobs replace the month they are run for, also when its logs hold nothing any more."""
    warehouse = Warehouse(spark, schema=f"wf_e2e_{uuid.uuid4().hex[:8]}")
    warehouse.setup()
    watch, line = tmp_path / "watch", {"_source": {"Contract": "C1", "Mac": "M", "AppName": "VOD", "TotalDuration": 5}}
    watch.mkdir()
    (watch / "20220401.json").write_text(json.dumps(line) + "\n")
    assert jobs.run_interaction_etl(spark, str(watch), "20220401", "20220401", warehouse).count() == 1
    line["_source"]["Contract"] = "0"                                    # a corrected day without real contracts
    (watch / "20220401.json").write_text(json.dumps(line) + "\n")
    assert jobs.run_interaction_etl(spark, str(watch), "20220401", "20220401", warehouse).count() == 0

    genres = str(tmp_path / "genres")
    write_genre_mapping(spark.createDataFrame([("x", "Drama")], "most_searched string, Genre string"), genres)

    def searches(name, users):
        folder = str(tmp_path / name)
        frame = spark.createDataFrame([(u, "x", m) for u in users for m in ("202206", "202207")],
                                      "user_id string, keyword string, month string")
        frame.write.partitionBy("month").parquet(folder)
        return folder
    full, none = searches("first", ["u1", "u2"]), searches("second", [None])
    assert jobs.run_behavior_etl(spark, full, "202206", "202207", genres, warehouse).count() == 2
    assert jobs.run_behavior_etl(spark, none, "202206", "202207", genres, warehouse).count() == 0
    spark.sql("USE default")

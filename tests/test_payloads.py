"""Watch logs stored with every field."""

import json
import uuid
from datetime import date

import pytest

from tests.conftest import rows
from watchfold.plans import jobs
from watchfold.plans.warehouse import LOAD_LOG, RAW_TABLE, CheckFailed, Warehouse
from watchfold.sources import files

DAY1 = [{"_index": "h", "_id": 1, "_source": {"Contract": "C1", "Mac": "M1", "AppName": "VOD", "TotalDuration": 5, "Region": "n"}},
        {"_source": {"Contract": 77, "Mac": None, "AppName": "SPORT", "TotalDuration": "12.5"}},
        {"_source": {"Contract": "C3", "TotalDuration": "many", "Nested": {"a": [1, 2]}}}, {"other": True}]
DAY2 = [{"_id": "two", "_source": {"Contract": "C1", "Mac": "M1", "AppName": "KPLUS", "TotalDuration": 1e3, "Region": {"code": 4}}}]


@pytest.fixture
def folder(tmp_path):
    broken = ['{"_source": {', "17", "[1]", '"text"', "", "  \t "]
    (tmp_path / "20240101.json").write_text("\n".join([json.dumps(x) for x in DAY1] + broken) + "\n")
    (tmp_path / "20240102.json").write_text("\n".join(json.dumps(x) for x in DAY2) + "\n")
    return str(tmp_path)


def new(spark):
    w = Warehouse(spark, schema=f"wf_raw_{uuid.uuid4().hex[:8]}")
    w.setup()
    return w


def test_typed_rows_are_those_of_the_fixed_schema(spark, folder):
    payloads = files.read_watch_payloads(spark, folder, "20240101", "20240102")
    fixed = files.read_watch_logs(spark, folder, "20240101", "20240102")
    assert rows(files.typed_watch_logs(payloads)) == rows(fixed)


def test_every_field_and_line_is_kept(spark, folder):
    payloads = files.read_watch_payloads(spark, folder, "20240101", "20240102")
    assert sorted(r.malformed for r in payloads.filter("malformed IS NOT NULL").collect()) == \
        ['"text"', "17", "[1]", '{"_source": {']
    back = [json.loads(r.j) for r in payloads.filter("payload IS NOT NULL").selectExpr("to_json(payload) AS j").collect()]
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(back, key=key) == sorted(json.loads(json.dumps(DAY1 + DAY2)), key=key)
    extra = files.typed_watch_logs(payloads, {"region": ("_source.Region", "string"), "id": ("_id", "int"),
                                              "second": ("_source.Nested.a[1]", "int")})
    assert rows(extra.filter("Contract = 'C1'"), "region", "id") == [(None, None), ("n", 1)] or \
        rows(extra.filter("Contract = 'C1'"), "region", "id") == [("n", 1), ('{"code":4}', None)]
    assert rows(extra.filter("Contract = 'C3'"), "second") == [(2,)]


def test_drifting_schemas_by_day(spark, folder):
    got = {r.log_date.day: r for r in files.payload_schemas(
        files.read_watch_payloads(spark, folder, "20240101", "20240102")).collect()}
    assert (got[1].lines, got[1].malformed, got[2].lines, got[2].malformed) == (8, 4, 1, 0)
    assert "Region: STRING" in got[1].schema and "code: BIGINT" in got[2].schema
    assert "TotalDuration: VARIANT" in got[1].schema               # a number and text on one day


def test_ingest_then_facts(spark, folder):
    warehouse = new(spark)
    raw = jobs.run_ingest(spark, folder, "20240101", "20240102", warehouse)
    assert raw.count() == 9 and warehouse.malformed_raw().count() == 4
    assert json.loads(warehouse.table(LOAD_LOG).first().metrics)["malformed"] == 4
    direct = rows(jobs.run_interaction_etl(spark, folder, "20240101", "20240102", warehouse))
    assert direct and rows(jobs.run_interaction_etl(spark, "", "20240101", "20240102", warehouse, from_raw=True)) == direct
    jobs.run_ingest(spark, folder, "20240102", "20240102", warehouse)      # a day again
    assert warehouse.table(RAW_TABLE).count() == 9
    with pytest.raises(CheckFailed, match="malformed_share = 0.5"):
        jobs.run_ingest(spark, folder, "20240101", "20240101", warehouse, max_malformed_share=0.1)
    assert warehouse.table(RAW_TABLE).count() == 9
    extra = warehouse.raw_logs(date(2024, 1, 1), date(2024, 1, 1), {"region": ("_source.Region", "string")})
    assert rows(extra.filter("region IS NOT NULL"), "region") == [("n",)]
    spark.sql("USE default")


def test_missing_days(spark, folder):
    assert files.read_watch_payloads(spark, folder, "20240101", "20240105", missing="skip").count() == 9
    with pytest.raises(Exception, match="20240105"):
        files.read_watch_payloads(spark, folder, "20240105", "20240105").count()
    with pytest.raises(ValueError):
        files.read_watch_payloads(spark, folder, "20240101", "20240102", missing="never")

"""Every registered query against its DuckDB oracle at sf0.001, plus the driver entry."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF0001
from tools.oracle_check import TABLES, compare

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_of_the_package_has_an_oracle():
    from watchfold.plans.registry import QUERIES as OWN
    assert set(OWN) <= set(ORACLE)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF0001).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert compare(got, want) is None


def test_entry_smoke(spark):
    df = entry.entry(spark)
    out = df.collect()
    assert len(out) == 5 * len({r.month_yyyymm for r in out}) >= 10
    assert df.columns == ["month_yyyymm", "program_name", "total_duration", "total_duration_hours",
                          "distinct_contract_count", "avg_active_days"]

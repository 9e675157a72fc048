import re

import pytest

from tests.conftest import rows
from watchfold.operators import analytics as an

FACT = ("Contract string, Entertainment bigint, Kids bigint, Movies bigint, Sports bigint, "
        "TV_Channel bigint, TotalDevices bigint, Most_Watch string, customer_taste string, "
        "Active_Days bigint, month_yyyymm string")
BFACT = "user_id string, Previous_Genre string, Trending_Type string, month_yyyymm string"


def fact(spark, data):
    return spark.createDataFrame(data, FACT)


def frow(contract, ent=0, kids=0, movies=0, sports=0, tv=0, devices=1, days=1, month="202401",
         taste="Movies"):
    return (contract, ent, kids, movies, sports, tv, devices, "Movies", taste, days, month)


def test_active_days_distribution_bins_and_order(spark):
    data = [frow("C1", days=None), frow("C2", days=0), frow("C3", days=4), frow("C4", days=5),
            frow("C5", days=29), frow("C6", days=30), frow("C7", days=-1), frow("C8", days=4, month="202402")]
    out = [(r.month_yyyymm, r.active_days_bin, r.distinct_contract_count)
           for r in an.active_days_distribution(fact(spark, data)).collect()]
    assert out == [("202401", "0-5", 2), ("202401", "5-10", 1), ("202401", "25-30", 1),
                   ("202401", "30", 2), ("202401", "Unknown", 1), ("202402", "0-5", 1)]
    one = an.active_days_distribution(fact(spark, data), month="202402").collect()
    assert [(r.active_days_bin, r.distinct_contract_count) for r in one] == [("0-5", 1)]


def test_program_stats_always_five_rows(spark):
    data = [frow("C1", movies=7200, tv=10, days=10), frow("C2", movies=3600, days=20),
            frow("C3", movies=0, tv=0, days=5)]
    got = {r.program_name: r for r in an.program_duration_stats(fact(spark, data)).collect()}
    assert sorted(got) == ["Entertainment", "Kids", "Movies", "Sports", "TV_Channel"]
    movies = got["Movies"]
    assert (movies.total_duration, movies.total_duration_hours, movies.distinct_contract_count,
            movies.avg_active_days) == (10800, 3.0, 2, 15.0)
    kids = got["Kids"]
    assert (kids.total_duration, kids.total_duration_hours, kids.distinct_contract_count,
            kids.avg_active_days) == (None, None, 0, None)
    assert got["TV_Channel"].distinct_contract_count == 1


def test_program_stats_equals_union_all_form(spark):
    from tests.conftest import SF001
    from watchfold.plans.registry import fact_interaction
    f = fact_interaction(spark, SF001)
    f.createOrReplaceTempView("fi_union_check")
    union = "\nUNION ALL\n".join(
        f"SELECT month_yyyymm, '{p}' AS program_name, SUM({p}) FILTER (WHERE {p} > 0) AS total_duration, "
        f"SUM({p}) FILTER (WHERE {p} > 0) / 3600 AS total_duration_hours, "
        f"COUNT(DISTINCT Contract) FILTER (WHERE {p} > 0) AS distinct_contract_count, "
        f"AVG(Active_Days) FILTER (WHERE {p} > 0) AS avg_active_days FROM fi_union_check GROUP BY month_yyyymm"
        for p in ["Entertainment", "Kids", "Movies", "Sports", "TV_Channel"])
    assert rows(an.program_duration_stats(f)) == rows(spark.sql(union))


def test_taste_distribution(spark):
    data = [frow("C1", taste="Movies"), frow("C2", taste="Movies"), frow("C3", taste="Kids,Movies")]
    out = [(r.customer_taste, r.distinct_contract_count) for r in an.taste_distribution(fact(spark, data)).collect()]
    assert out == [("Movies", 2), ("Kids,Movies", 1)]


def test_top_contracts(spark):
    data = [frow(f"C{i:02d}", tv=i % 7) for i in range(15)] + [frow("X1", tv=100, month="202402")]
    f = fact(spark, data)
    top = an.top_contracts(f, " Tv Channel ", k=10, month="202401").collect()
    assert len(top) == 10 and {r.Program for r in top} == {"TV CHANNEL"}
    durations = [r.Duration for r in sorted(top, key=lambda r: (-r.Duration, r.Contract))]
    assert durations == [6, 6, 5, 5, 4, 4, 3, 3, 2, 2]
    assert sorted(r.Contract for r in top if r.Duration == 6) == ["C06", "C13"]
    assert sorted(r.Contract for r in top if r.Duration == 2) == ["C02", "C09"]
    per_month = an.top_contracts(f, "tv", k=10)
    assert per_month.filter("month_yyyymm = '202402'").count() == 1
    unknown = an.top_contracts(f, "zzz", k=10, month="202401").collect()
    assert len(unknown) == 10 and all(r.Duration is None for r in unknown)
    assert sorted(r.Contract for r in unknown) == [f"C{i:02d}" for i in range(10)]


@pytest.mark.parametrize("k", [10, 5000])
def test_top_contracts_ranks_parts_before_the_month(spark, k):
    f = fact(spark, [frow(f"C{i}", tv=i) for i in range(50)])
    plan = an.top_contracts(f, "tv", k)._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any("part#" in e for e in exchanges)              # the month's parts first
    assert an.top_contracts(f, "tv", k).count() == min(k, 50)
    one = an.top_contracts(f, "tv", k, month="202401")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in one


def test_top_contracts_overall(spark):
    f = fact(spark, [frow("C1", tv=5), frow("C1", tv=9, month="202402"), frow("C2", tv=7)])
    assert [tuple(r) for r in an.top_contracts_overall(f, "tv", 2).collect()] == [("C1", "TV", 9), ("C2", "TV", 7)]


def test_avg_total_devices(spark):
    data = [frow("C1", devices=2), frow("C2", devices=5)]
    assert rows(an.avg_total_devices(fact(spark, data))) == [("202401", 3.5)]


def test_genre_change_percent_rounding_and_empty(spark):
    b = spark.createDataFrame([("u1", "Drama", "Changed", "202207"), ("u2", "Unchanged", "Unchanged", "202207"),
                               ("u3", "News", "Changed", "202207"), ("u4", "News", "Changed", "202208"),
                               ("u5", "Unchanged", "Unchanged", "202208"), ("u6", "Unchanged", "Unchanged", "202208"),
                               (None, "News", "Changed", "202209")], BFACT)
    got = dict((r[0], r[1]) for r in an.genre_change_percent(b).collect())
    assert got == {"202207": 66.67, "202208": 33.33, "202209": None}
    empty = spark.createDataFrame([], BFACT)
    assert an.genre_change_percent(empty).count() == 0


def test_changed_by_previous_genre(spark):
    b = spark.createDataFrame([("u1", "Drama", "Changed", "202207"), ("u2", "Unchanged", "Unchanged", "202207"),
                               ("u3", "News", "Changed", "202207"), ("u4", "News", "Changed", "202207")], BFACT)
    out = [(r.Previous_Genre, r.changed_user_count) for r in an.changed_by_previous_genre(b).collect()]
    assert out == [("News", 2), ("Drama", 1)]


def test_behavior_sample(spark):
    b = spark.createDataFrame([(f"u{i:03d}", "Drama", "Changed", "202207") for i in range(150)], BFACT)
    sample = an.behavior_sample(b, 100).collect()
    assert len(sample) == 100 and sample[0].user_id == "u000" and sample[-1].user_id == "u099"


def test_dims_and_checks(spark):
    f = fact(spark, [frow("C1"), frow("C1", month="202402"), frow("C2")])
    b = spark.createDataFrame([("u1", "Drama", "Changed", "202207"), ("u1", "Drama", "Changed", "202208"),
                               (None, "Drama", "Changed", "202208")], BFACT)
    assert rows(an.dim_contract(f)) == [("C1",), ("C2",)]
    assert rows(an.dim_user(b)) == [("u1",)]
    assert an.check_row_counts(f, b).collect()[0].asDict() == {"fact_interaction_rows": 3, "fact_behavior_rows": 3}
    uniq = an.check_dim_uniqueness(an.dim_user(b), an.dim_contract(f)).collect()[0].asDict()
    assert uniq == {"dim_user_rows": 1, "dim_user_distinct": 1, "dim_contract_rows": 2, "dim_contract_distinct": 2}
    nulls = an.check_null_keys(b, f).collect()[0].asDict()
    assert nulls == {"null_user_id_rows": 1, "null_contract_rows": 0}
    empty = spark.createDataFrame([], BFACT)
    assert an.check_null_keys(empty, f).collect()[0].asDict() == {"null_user_id_rows": None,
                                                                   "null_contract_rows": 0}


def test_checks_plan_has_no_join(spark):
    f = fact(spark, [frow("C1")])
    b = spark.createDataFrame([("u1", "Drama", "Changed", "202207")], BFACT)
    plan = an.check_row_counts(f, b)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_distinct_counts_for_tables_with_repeated_keys(spark):
    f = fact(spark, [frow("C1"), frow("C1"), frow("C2")])
    assert rows(an.taste_distribution(f), "distinct_contract_count") == [(2,)]
    assert rows(an.active_days_distribution(f), "distinct_contract_count") == [(2,)]
    b = spark.createDataFrame([("u1", "Drama", "Changed", "202207"), ("u1", "Drama", "Changed", "202207"),
                               ("u2", "Unchanged", "Unchanged", "202207")], BFACT)
    assert rows(an.genre_change_percent(b)) == [("202207", 50.0)]
    assert rows(an.changed_by_previous_genre(b), "changed_user_count") == [(1,)]


def test_program_stats_of_an_empty_month_has_five_rows(spark):
    out = rows(an.program_duration_stats(fact(spark, [frow("C1", tv=5)]), month="209901"))
    assert [(r[0], r[2], r[4]) for r in out] == [("209901", None, 0)] * 5

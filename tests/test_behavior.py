import re

from tests.conftest import SF001, rows
from watchfold.operators import behavior as bh
from watchfold.sources.fixtures import DriverTables, genre_mapping_fixture, log_search_fixture

SEARCH = "user_id string, keyword string, month_yyyymm string"
MAPPING = "most_searched string, Genre string"


def searches(spark, data):
    return spark.createDataFrame(data, SEARCH)


def mapping(spark, pairs):
    return spark.createDataFrame(list(pairs.items()), MAPPING)


def test_null_keys_ignored_and_frequency(spark):
    df = searches(spark, [("u1", "a", "202206"), ("u1", "a", "202206"), (None, "a", "202206"),
                          ("u1", None, "202206"), ("u2", "b", "202206")])
    assert rows(bh.keyword_frequency(df)) == [("202206", "u1", "a", 2), ("202206", "u2", "b", 1)]


def test_most_searched_tie_first_by_name(spark):
    df = searches(spark, [("u1", "b", "202206"), ("u1", "a", "202206"), ("u1", "c", "202206"),
                          ("u1", "c", "202206"), ("u2", "z", "202206"), ("u2", "y", "202206")])
    got = rows(bh.most_searched(df))
    assert got == [("202206", "u1", "c"), ("202206", "u2", "y")]


def test_month_from_log_date(spark):
    import datetime as dt
    df = spark.createDataFrame([("u1", "a", dt.date(2022, 6, 3))], "user_id string, keyword string, log_date date")
    assert rows(bh.most_searched(df)) == [("202206", "u1", "a")]


def test_trend_rules(spark):
    data = [("u1", "x", "202206"), ("u1", "x", "202207"),     # Drama -> Drama
            ("u2", "x", "202206"), ("u2", "n", "202207"),     # Drama -> News
            ("u3", "x", "202207"),                            # one month only
            ("u4", "q", "202206"), ("u4", "x", "202207"),     # unmapped keyword in the first month
            ("u5", "x", "202205"), ("u5", "n", "202207"),     # months not adjacent
            ("u6", "g", "202206"), ("u6", "g", "202207")]     # NULL genre -> Changed
    m = mapping(spark, {"x": "Drama", "n": "News", "g": None})
    fact = rows(bh.fact_behavior(searches(spark, data), m))
    assert fact == [("u1", "Unchanged", "Unchanged", "202207"),
                    ("u2", "Drama", "Changed", "202207"),
                    ("u6", None, "Changed", "202207")]


def test_explicit_pair_matches_backfill_and_allows_gaps(spark):
    data = [("u1", "x", "202206"), ("u1", "x", "202207"), ("u2", "x", "202206"), ("u2", "n", "202207"),
            ("u5", "x", "202205"), ("u5", "n", "202207")]
    m = mapping(spark, {"x": "Drama", "n": "News"})
    df = searches(spark, data)
    pair = rows(bh.fact_behavior_between(df, m, "202206", "202207"))
    assert pair == rows(bh.fact_behavior(df, m))
    gap = rows(bh.fact_behavior_between(df, m, "202205", "202207"))
    assert gap == [("u5", "Drama", "Changed", "202207")]


def test_users_desc_as_strings(spark):
    df = spark.createDataFrame([("9",), ("10",), ("100",)], "user_id string")
    assert [r.user_id for r in bh.order_users_desc(df).collect()] == ["9", "100", "10"]


def test_distinct_programs(spark):
    df = spark.createDataFrame([("202206", "u1", "a"), ("202207", "u2", "a"), ("202207", "u3", "b")],
                               "month_yyyymm string, user_id string, most_searched string")
    assert rows(bh.distinct_programs(df)) == [("a",), ("b",)]


def test_repeated_mapping_keys_pair_every_genre(spark):
    log = spark.createDataFrame([("u1", "kw", "202206"), ("u1", "kw", "202207")],
                                "user_id string, keyword string, month_yyyymm string")
    twice = spark.createDataFrame([("kw", "Drama"), ("kw", "News")], "most_searched string, Genre string")
    month = rows(bh.fact_behavior(log, twice))
    mapped = bh.genre_mapped(bh.most_searched(log), twice)
    assert month == rows(bh.genre_trend(mapped).select(*bh.FACT_COLUMNS))
    assert month == rows(bh.fact_behavior_between(log, twice, "202206", "202207"))
    assert [(r[1], r[2]) for r in month] == [("Drama", "Changed"), ("News", "Changed"),
                                             ("Unchanged", "Unchanged"), ("Unchanged", "Unchanged")]


def test_fixture_fact_has_both_trend_types(spark):
    tables = DriverTables(spark, SF001)
    fact = bh.fact_behavior(log_search_fixture(tables), genre_mapping_fixture(tables))
    kinds = dict(fact.groupBy("Trending_Type").count().collect())
    assert kinds["Changed"] > kinds["Unchanged"] > 0
    assert fact.columns == bh.FACT_COLUMNS


def test_listings_of_one_genre_are_counted(spark):
    log = searches(spark, [("u1", "kw", "202206"), ("u1", "kw", "202207"), ("u2", "kw", "202206"), ("u2", "x", "202207")])
    listed = spark.createDataFrame([("kw", "Drama")] * 3 + [("kw", None)] * 2 + [("x", "News")] * 2, MAPPING)
    mapped = bh.genre_mapped(bh.most_searched(log), listed)
    before, now = (mapped.filter(f"month_yyyymm = {m!r}") for m in ("202206", "202207"))
    want = rows(bh.trend_between(before, now, "202207").select(*bh.FACT_COLUMNS))      # the plain join
    assert len(want) == 25 + 10
    assert rows(bh.fact_behavior(log, listed)) == rows(bh.fact_behavior_between(log, listed, "202206", "202207")) == want
    assert rows(bh.genre_trend(mapped).select(*bh.FACT_COLUMNS)) == want


def test_pair_of_a_month_with_itself(spark):
    log, m = searches(spark, [("u1", "x", "202206"), ("u2", "q", "202206")]), mapping(spark, {"x": "Drama"})
    assert rows(bh.fact_behavior_between(log, m, "202206", "202206")) == [("u1", "Unchanged", "Unchanged", "202206")]


def executed_plan(frame):
    frame.write.format("noop").mode("overwrite").save()      # runs the frame's own plan under adaptive execution
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_the_log_is_read_once(spark):
    tables = DriverTables(spark, SF001)
    log, m = log_search_fixture(tables), genre_mapping_fixture(tables)
    for frame in (bh.fact_behavior(log, m), bh.genre_trend(bh.genre_mapped(bh.most_searched(log), m)),
                  bh.fact_behavior_between(log, m, "199501", "199502")):
        plan = executed_plan(frame)
        assert len(re.findall(r"Scan parquet[^\n]*l_orderkey", plan)) == 1
        assert "Window" not in plan


def test_one_candidate_of_a_hot_user_crosses(spark):
    """Counts and candidates are combined before their exchanges."""
    plan = bh.most_searched(log_search_fixture(DriverTables(spark, SF001)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_min" in plan and plan.count("Exchange hashpartitioning") == 2

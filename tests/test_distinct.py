"""Mergeable distinct counts against COUNT(DISTINCT)."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_analytics import FACT, frow
from watchfold.operators import analytics as an
from watchfold.operators import distinct as di

BFACT = "user_id string, Previous_Genre string, Trending_Type string, month_yyyymm string"


@pytest.fixture(scope="module")
def fact(spark):
    data = [frow(f"C{i}", tv=i % 3, movies=i % 5, days=i % 33, month=m, taste="Movies" if i % 2 else "TV_Channel")
            for m in ("202204", "202205", "202207") for i in range(0, 40, 1 + int(m[-1]) % 3)]
    data += [frow("C1", tv=4, days=1, month="202204"), frow("C1", tv=4, days=1, month="202204"),      # repeated keys
             frow(None, tv=4, days=2, month="202204")]
    return spark.createDataFrame(data, FACT)


def test_numbers_are_dense_and_stay(spark):
    keys = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "k string")
    first = di.numbered_dimension(keys, "k")
    assert rows(first) == [("a", 1), ("b", 2)]
    more = spark.createDataFrame([("0",), ("b",), ("z",), (None,)], "k string")
    assert rows(di.numbered_dimension(more, "k", first)) == [("0", 3), ("a", 1), ("b", 2), ("z", 4)]
    assert di.numbered_dimension(keys.limit(0), "k").count() == 0


def test_counts_equal_count_distinct(fact):
    bitmaps = di.key_bitmaps(fact, di.numbered_dimension(fact, "Contract"), "Contract", di.interaction_measures())
    assert [f"{f.name} {f.dataType.simpleString()}" for f in bitmaps.schema] == di.BITMAP_SCHEMA.split(", ")
    assert rows(di.active_days_distribution(bitmaps)) == rows(an.active_days_distribution(fact.dropna(subset=["Contract"])))
    named = fact.dropna(subset=["Contract"])
    assert rows(di.taste_distribution(bitmaps)) == rows(an.taste_distribution(named))
    assert rows(di.taste_reach(bitmaps)) == rows(named.groupBy("customer_taste").agg(F.count_distinct("Contract")))
    for p in ("TV_Channel", "Movies"):
        reach = named.filter(F.col(p) > 0).select("Contract").distinct().count()
        assert di.program_reach(bitmaps).filter(F.col("program_name") == p).first().contracts == reach


def test_more_than_one_bucket(spark):
    """Keys beyond the 32,768 of one bitmap."""
    fact = spark.range(70_000).select(F.concat(F.lit("C"), "id").alias("Contract"), F.lit("202204").alias("month_yyyymm"),
                                      (F.col("id") % 7).cast("string").alias("label"))
    bitmaps = di.key_bitmaps(fact.union(fact.limit(500)), di.numbered_dimension(fact, "Contract"), "Contract",
                             {"all": F.lit("all"), "label": F.when(F.col("label") != "0", F.col("label"))})
    assert bitmaps.select("bucket").distinct().count() == 3
    assert di.counts(bitmaps, "all", "month_yyyymm").first()["keys"] == 70_000
    assert rows(di.counts(bitmaps, "label", "label")) == [(str(k), 10_000) for k in range(1, 7)]


def test_loads_merge(fact):
    dimension = di.numbered_dimension(fact, "Contract")
    build = lambda f: di.key_bitmaps(f, dimension, "Contract", di.interaction_measures())
    parts = [fact.filter("month_yyyymm = '202204' OR TV_Channel > 0"), fact.filter("month_yyyymm > '202204'"), fact.limit(0)]
    merged = di.merge(*map(build, parts))
    assert rows(merged, "measure", "month_yyyymm", "label", "bucket", F.bitmap_count("bitmap")) == \
        rows(build(fact), "measure", "month_yyyymm", "label", "bucket", F.bitmap_count("bitmap"))


def test_retention_and_change(spark):
    data = [("u1", "Unchanged", "Unchanged", "202112"), ("u2", "Drama", "Changed", "202112"), ("u2", "News", "Changed", "202112"),
            ("u2", "Drama", "Changed", "202201"), ("u3", None, "Changed", "202201"), ("u4", "Unchanged", "Unchanged", "202201"),
            ("u4", "Unchanged", "Unchanged", "202203"), (None, "Drama", "Changed", "202203")]
    fact = spark.createDataFrame(data, BFACT)
    bitmaps = di.key_bitmaps(fact, di.numbered_dimension(fact, "user_id"), "user_id", di.behavior_measures())
    assert rows(di.retention(bitmaps)) == [("202201", 1, 2, 1)]                 # 202203 has no month before it
    assert rows(di.genre_change_percent(bitmaps)) == rows(an.genre_change_percent(fact))
    want = an.changed_by_previous_genre(fact.dropna(subset=["user_id"])).dropna(subset=["Previous_Genre"])
    got = di.counts(bitmaps, "changed_from", "month_yyyymm", "label")
    assert rows(got) == rows(want)

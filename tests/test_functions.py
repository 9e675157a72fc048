import datetime as dt

from pyspark.sql import functions as F

from watchfold.functions import (
    GENRES,
    WATCH_TYPES,
    active_days_bin,
    active_days_bin_order,
    app_category,
    month_index,
    month_of,
    program_duration,
    program_label,
    rule_genre,
    valid_contract,
)
from watchfold.operators.labelling import rule_label


def test_app_category_exact_and_case_sensitive(spark):
    names = ["CHANNEL", "DSHD", "KPLUS", "KPlus", "kplus", "VOD", "FIMS_RES", "BHD_RES", "VOD_RES",
             "FIMS", "BHD", "DANET", "RELAX", "CHILD", "SPORT", "XAPP", None]
    df = spark.createDataFrame([(n,) for n in names], "AppName string")
    got = dict((r[0], r[1]) for r in df.select("AppName", app_category().alias("t")).collect())
    assert got["CHANNEL"] == got["DSHD"] == got["KPLUS"] == got["KPlus"] == "TV_Channel"
    assert {got[n] for n in ["VOD", "FIMS_RES", "BHD_RES", "VOD_RES", "FIMS", "BHD", "DANET"]} == {"Movies"}
    assert (got["RELAX"], got["CHILD"], got["SPORT"]) == ("Entertainment", "Kids", "Sports")
    assert got["kplus"] == got["XAPP"] == got[None] == "Error"


def test_watch_types_sorted_like_sort_array():
    assert WATCH_TYPES == ["Entertainment", "Error", "Kids", "Movies", "Sports", "TV_Channel"]


def test_valid_contract(spark):
    df = spark.createDataFrame([(None,), ("",), ("0",), ("C1",), (" ",)], "c string")
    assert sorted(r.c for r in df.filter(valid_contract("c")).collect()) == [" ", "C1"]


def test_active_days_bins_and_order(spark):
    values = [None, 0, 4, 5, 9, 10, 14, 15, 19, 20, 24, 25, 29, 30, 31, -1]
    df = spark.createDataFrame([(v,) for v in values], "Active_Days bigint")
    got = [(r[0], r[1]) for r in df.select("Active_Days", active_days_bin().alias("b")).collect()]
    assert got == [(None, "Unknown"), (0, "0-5"), (4, "0-5"), (5, "5-10"), (9, "5-10"),
                   (10, "10-15"), (14, "10-15"), (15, "15-20"), (19, "15-20"), (20, "20-25"),
                   (24, "20-25"), (25, "25-30"), (29, "25-30"), (30, "30"), (31, "30"), (-1, "30")]
    labels = ["0-5", "5-10", "10-15", "15-20", "20-25", "25-30", "30", "Unknown"]
    bins = spark.createDataFrame([(b,) for b in labels], "active_days_bin string")
    order = [r[1] for r in bins.select("active_days_bin", active_days_bin_order()).collect()]
    assert order == [1, 2, 3, 4, 5, 6, 7, 8]


def test_program_duration_synonyms(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)],
                               "Entertainment bigint, Kids bigint, Movies bigint, Sports bigint, TV_Channel bigint")
    cases = {"Entertainment": 1, " kids ": 2, "MOVIES": 3, "sports": 4, "tv": 5, "TV_Channel": 5,
             " Tv Channel ": 5, "tvchannel": 5, "zzz": None, "tv-channel": None}
    for name, expected in cases.items():
        assert df.select(program_duration(name)).first()[0] == expected, name
    assert df.select(program_label(" Tv Channel ")).first()[0] == "TV CHANNEL"


def test_month_tags(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31),), (dt.date(1999, 12, 1),)], "d date")
    got = df.select(month_of("d").alias("m")).select("m", month_index("m").alias("i")).collect()
    assert [(r.m, r.i) for r in got] == [("202401", 2024 * 12), ("199912", 1999 * 12 + 11)]


RULE_KEYWORDS = ["thuyếtminh", "bigfoot", "capdoi", "ARGEN", "nhật ký", "PENT", "running", "VTV3",
                 "vtv1 news", "HTV7", "Discovery Channel", "Running Man", "the master key", "Reality X",
                 "SEXY", "romantic night", "I love you", "harry potter", "Hogwarts", "small ring", "",
                 "argen", "channel love"]


def test_rule_genre(spark):
    keywords = RULE_KEYWORDS
    df = spark.createDataFrame([(k,) for k in keywords], "k string")
    jvm = dict((r[0], r[1]) for r in df.select("k", rule_genre("k")).collect())
    for k in keywords:
        assert jvm[k] == rule_label(k), k
        assert jvm[k] in GENRES
    assert jvm["VTV3"] == "TV Channel" and jvm["Discovery Channel"] == "TV Channel"
    assert jvm["Running Man"] == "Reality Show" and jvm["the master key"] == "Reality Show"
    assert jvm["I love you"] == "Romance" and jvm["harry potter"] == "Drama"
    assert jvm["bigfoot"] == "Horror" and jvm["PENT"] == "C Drama" and jvm["argen"] == "Other"
    assert jvm["channel love"] == "TV Channel"      # rules apply in the prompt's order
    assert jvm["small ring"] == "Other"

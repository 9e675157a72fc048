"""The driver's tables re-shaped into the inputs the reference reads.

The driver ships no watch or search logs, so both are derived from its tables
by plain relational expressions that DuckDB can run too (the oracle states the
same derivation in SQL, see :mod:`watchfold.plans.oracle`). Every row of the source
tables is kept: the modulo expressions only choose values. They are chosen so that
each rule has something to bite on: placeholder contracts, unknown apps, NULL and
zero durations, contracts active on one day or on all days of one, two or three
months; NULL users and keywords, keywords that hit every labelling rule and
example and whose number grows with the table; keywords mapped twice, to a genre
outside the list, or not at all.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold.functions.constants import APP_CATEGORIES, GENRES

# Every known app name and one unknown name, so every category and ``Error`` occurs.
FIXTURE_APPS = [app for apps in APP_CATEGORIES.values() for app in apps] + ["XAPP"]
# Words put after a part's name so that each labelling rule is hit, and whole
# keywords that are worked examples.
RULE_WORDS = ["htv7", "CHANNEL", "Master Key", "Reality", "romantic", "Love", "hogwarts", "plain"]
EXAMPLE_KEYWORDS = ["VTV3", "running", "nhật ký"]
FIRST_DAY = "2024-01-01"


@dataclass
class DriverTables:
    """Lazy loader for ``{sf_dir}/{name}.parquet``; each table is read once per instance."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def __call__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        return self._cache[name]


def log_content_fixture(tables: DriverTables) -> DataFrame:
    """Watch log rows ``Contract, Mac, AppName, TotalDuration, log_date`` from ``events``.

    Placeholder contracts (NULL, '' and '0'), an unknown app, NULL and zero
    durations all occur; ``log_date`` stands in for the daily file name.
    """
    ev = tables("events").select("event_id", "ts", "user_id", "value")
    uid, eid = F.col("user_id"), F.col("event_id")
    contract = (F.when(uid % 50 == 49, F.lit(None).cast("string"))
                .when(uid % 50 == 48, F.lit(""))
                .when(uid == 0, F.lit("0"))
                .otherwise(F.concat(F.lit("C"), uid.cast("string"))))
    app = F.element_at(F.array(*[F.lit(a) for a in FIXTURE_APPS]),
                       (eid % (uid % len(FIXTURE_APPS) + 1)).cast("int") + 1)
    # user u is seen on at most u % 31 + 1 days of a month, in one month or in two
    day = (F.dayofmonth("ts") - 1) % (uid % 31 + 1) + F.when((uid % 3 == 0) & (eid % 2 == 1), 31).otherwise(0)
    duration = (F.when(eid % 97 == 0, F.lit(None).cast("bigint"))
                .when(eid % 89 == 0, F.lit(0).cast("bigint"))
                .otherwise(F.round(F.col("value") * 100).cast("bigint")))
    return ev.select(
        contract.alias("Contract"),
        F.concat(F.lit("M"), (uid * 4 + eid % 4).cast("string")).alias("Mac"),
        app.alias("AppName"),
        duration.alias("TotalDuration"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), day.cast("int")).alias("log_date"),
    )


def keyword_of(name: str = "p_name", key: str = "p_partkey"):
    """Search keyword of a part: one in forty a worked example, the others its name, a rule
    word and a number that makes keywords grow with the table."""
    k = F.col(key)
    pick = lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), at.cast("int") + 1)
    return (F.when(k % 40 == 0, pick(EXAMPLE_KEYWORDS, F.floor(k / 40) % len(EXAMPLE_KEYWORDS)))
            .otherwise(F.concat_ws(" ", name, pick(RULE_WORDS, k % len(RULE_WORDS)),
                                   F.floor(k / 8).cast("string"))))


def log_search_fixture(tables: DriverTables) -> DataFrame:
    """Search log rows ``user_id, keyword, log_date``: one search per order line, the
    part's keyword, the order date as search date. Some users and keywords are NULL."""
    o = tables("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = tables("lineitem").select("l_orderkey", "l_partkey")
    p = tables("part").select("p_partkey", keyword_of().alias("part_keyword"))
    joined = (li.join(o, li.l_orderkey == o.o_orderkey)
                .join(p, li.l_partkey == p.p_partkey))
    return joined.select(
        F.when(F.col("o_custkey") % 101 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
        F.when(F.col("l_orderkey") % 53 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("part_keyword")).alias("keyword"),
        F.to_date("o_orderdate").alias("log_date"),
    )


def genre_mapping_fixture(tables: DriverTables) -> DataFrame:
    """Keyword -> genre mapping ``most_searched, Genre`` over the parts' distinct keywords.

    One key in eight carries a prefix that no search has, so its keyword is unmapped;
    keys divisible by 30 have a genre outside the list; every keyword whose key is
    divisible by 11 is listed a second time, under another genre. Only the first four
    genres of the list are used otherwise, so that some users keep theirs."""
    keys = tables("part").groupBy(keyword_of().alias("keyword")).agg(F.min("p_partkey").alias("k"))
    k = F.col("k")
    genre = lambda at: F.element_at(F.array(*[F.lit(g) for g in GENRES[:4]]), at.cast("int") + 1)
    listed = F.when(k % 8 == 7, F.concat(F.lit("unsearched "), "keyword")).otherwise(F.col("keyword"))
    first = keys.select(listed.alias("most_searched"),
                        F.when(k % 30 == 0, F.lit("Fantasy")).otherwise(genre(k % 4)).alias("Genre"))
    again = keys.filter(k % 11 == 0).select(listed.alias("most_searched"), genre((k + 1) % 4).alias("Genre"))
    return first.unionByName(again)

"""Behaviour fact: search logs -> each user's most searched keyword per month,
its genre, and the month-over-month genre change.

Input rows are ``user_id, keyword, month_yyyymm``.

Plan shape: the log is read once. The (month, user, keyword) counts are combined
map-side before the first exchange, which spreads a hot user over all tasks. The top
keyword of a (month, user) is an ordered aggregate, also combined before the second
exchange, so a user holding a third of all searches ships one candidate per task.
The genre lookup carries no hint: the optimizer and adaptive execution
choose from the mapping's real size. The month pairing is no self-join: a mapped row is sent
once as the current one of its month and once as the previous one of the next, and the few
genres that meet at a (user, month) are paired inside the row. A keyword that the mapping lists under
several genres pairs all of them, as the reference's join does; listings of
the same genre travel as one row with their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold.functions.columns import month_index, month_of

FACT_COLUMNS = ["user_id", "Previous_Genre", "Trending_Type", "month_yyyymm"]
UNCHANGED, CHANGED = "Unchanged", "Changed"


def search_rows(log_search: DataFrame) -> DataFrame:
    """Keep ``month_yyyymm, user_id, keyword`` of rows with both keys present.
    A ``log_date`` column, when there is no month tag yet, gives the month."""
    if "month_yyyymm" not in log_search.columns:
        log_search = log_search.withColumn("month_yyyymm", month_of("log_date"))
    return (log_search.select("month_yyyymm", "user_id", "keyword")
            .filter(F.col("user_id").isNotNull() & F.col("keyword").isNotNull()))


def keyword_frequency(log_search: DataFrame) -> DataFrame:
    """Searches per (month, user, keyword) as ``frequency``."""
    return (search_rows(log_search)
            .groupBy("month_yyyymm", "user_id", "keyword")
            .agg(F.count(F.lit(1)).alias("frequency")))


def most_searched(log_search: DataFrame) -> DataFrame:
    """Most searched keyword per (month, user); ties go to the first keyword by name."""
    best = F.min(F.struct((-F.col("frequency")).alias("less"), "keyword"))
    return (keyword_frequency(log_search).groupBy("month_yyyymm", "user_id").agg(best.alias("best"))
            .select("month_yyyymm", "user_id", F.col("best.keyword").alias("most_searched")))


def order_users_desc(frame: DataFrame) -> DataFrame:
    """Final presentation order of the reference: user ids descending, as strings."""
    return frame.orderBy(F.col("user_id").desc())


def genre_mapped(top_keywords: DataFrame, mapping: DataFrame) -> DataFrame:
    """Attach the genre of each most-searched keyword (exact match). Keywords
    without a genre drop out, as in the reference's inner join."""
    return top_keywords.join(mapping.select("most_searched", "Genre"), "most_searched")


def _with_trend(pairs: DataFrame) -> DataFrame:
    """Add both trend columns to ``prev_genre, curr_genre`` pairs. They follow from one
    test: equal genres, where a NULL on either side counts as a change."""
    same = F.coalesce(F.col("prev_genre") == F.col("curr_genre"), F.lit(False))
    return pairs.withColumns({
        "Trending_Type": F.when(same, UNCHANGED).otherwise(CHANGED),
        "Previous_Genre": F.when(same, UNCHANGED).otherwise(F.col("prev_genre"))})


TREND_COLUMNS = ["month_yyyymm", "user_id", "prev_genre", "curr_genre", "Trending_Type", "Previous_Genre"]


def mapping_counts(mapping: DataFrame) -> DataFrame:
    """The mapping with one row per (keyword, genre) and how often it is listed, ``times``."""
    return mapping.groupBy("most_searched", "Genre").agg(F.count(F.lit(1)).alias("times"))


def _genre_mapped_counted(top_keywords: DataFrame, mapping: DataFrame) -> DataFrame:
    return top_keywords.join(mapping_counts(mapping), "most_searched")


def _paired(mapped: DataFrame, roles: Column) -> DataFrame:
    """Trend rows of ``month_yyyymm, user_id, Genre[, times]``. ``roles`` is an array of
    (slot, current): where a row stands as the current or as the previous one. One exchange, on
    (user, slot); the rows of a slot are the genres that the mapping lists two keywords under."""
    times = F.col("times") if "times" in mapped.columns else F.lit(1)
    sent = (mapped.select("user_id", "month_yyyymm", F.struct("Genre", times.alias("times")).alias("genre"),
                          F.explode(roles).alias("role"))
            .select("user_id", "month_yyyymm", "genre", "role.*"))
    met = sent.groupBy("user_id", "slot").agg(
        F.max(F.when(F.col("current"), F.col("month_yyyymm"))).alias("month_yyyymm"),
        F.collect_list(F.when(F.col("current"), F.col("genre"))).alias("now"),
        F.collect_list(F.when(~F.col("current"), F.col("genre"))).alias("before"))
    pairs = (met.filter((F.size("now") > 0) & (F.size("before") > 0))
             .select("month_yyyymm", "user_id", "before", F.explode("now").alias("now"))
             .select("month_yyyymm", "user_id", "now", F.explode("before").alias("before")))
    if "times" in mapped.columns:
        repeated = F.array_repeat(F.lit(0), (F.col("now.times") * F.col("before.times")).cast("int"))
        pairs = pairs.select("*", F.explode(repeated))
    return _with_trend(pairs.select("month_yyyymm", "user_id", F.col("before.Genre").alias("prev_genre"),
                                    F.col("now.Genre").alias("curr_genre"))).select(*TREND_COLUMNS)


def _role(slot: Column, current: bool) -> Column:
    return F.struct(slot.alias("slot"), F.lit(current).alias("current"))


def genre_trend(mapped: DataFrame) -> DataFrame:
    """Month-over-month trend for every month and its previous calendar month.

    A user counts in month m only when it has a genre in both m - 1 and m.
    Output ``month_yyyymm`` (the current month), ``user_id``, ``prev_genre``,
    ``curr_genre``, ``Trending_Type``, ``Previous_Genre``.
    """
    month = month_index("month_yyyymm")
    return _paired(mapped, F.array(_role(month, True), _role(month + 1, False)))


def trend_between(previous: DataFrame, current: DataFrame, month_yyyymm: str) -> DataFrame:
    """The reference's two-period form: inner join of two mapped periods on the
    user, tagged with ``month_yyyymm`` (the current period's month)."""
    before = previous.select("user_id", F.col("Genre").alias("prev_genre"))
    pairs = current.select("user_id", F.col("Genre").alias("curr_genre")).join(before, "user_id")
    return _with_trend(pairs.withColumn("month_yyyymm", F.lit(month_yyyymm))).select(*TREND_COLUMNS)


def fact_behavior(log_search: DataFrame, mapping: DataFrame) -> DataFrame:
    """Behaviour fact for every month that has a previous month in the logs."""
    mapped = _genre_mapped_counted(most_searched(log_search), mapping)
    return genre_trend(mapped).select(*FACT_COLUMNS)


def fact_behavior_between(log_search: DataFrame, mapping: DataFrame,
                          previous_month: str, current_month: str) -> DataFrame:
    """Behaviour fact of one explicit pair of periods (they need not be adjacent),
    tagged with the current period's month, as the reference's ETL run."""
    month = F.col("month_yyyymm")
    rows = search_rows(log_search).filter(month.isin(previous_month, current_month))
    mapped = _genre_mapped_counted(most_searched(rows), mapping)
    roles = F.array_compact(F.array(F.when(month == current_month, _role(F.lit(0), True)),
                                    F.when(month == previous_month, _role(F.lit(0), False))))
    return _paired(mapped, roles).select(*FACT_COLUMNS)


def distinct_programs(top_keywords: DataFrame) -> DataFrame:
    """Distinct most-searched keywords over all periods (the labelling input)."""
    return (top_keywords.select("most_searched")
            .filter(F.col("most_searched").isNotNull())
            .distinct())

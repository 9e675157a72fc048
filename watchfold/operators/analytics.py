"""Views, top-k report, KPIs, dimensions and data-quality checks over the facts.

Facts accumulate one partition per month, so every result here is grouped by
``month_yyyymm`` (pass ``month=`` to look at one month only); without that,
sums would mix months and a contract could sit in two bins. Distinct contracts
and users are counted as such, also on a table with repeated keys.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchfold.functions.columns import (
    active_days_bin,
    active_days_bin_order,
    program_duration,
    program_label,
)
from watchfold.functions.constants import PROGRAM_TYPES
from watchfold.operators.behavior import UNCHANGED


def _month(fact: DataFrame, month: str | None) -> DataFrame:
    return fact.filter(F.col("month_yyyymm") == month) if month else fact


# --- views -----------------------------------------------------------------

def active_days_distribution(fact: DataFrame, month: str | None = None) -> DataFrame:
    """Distinct contracts per active-days bin, bins in display order."""
    binned = _month(fact, month).select("month_yyyymm", "Contract",
                                        active_days_bin("Active_Days").alias("active_days_bin"))
    return (binned.groupBy("month_yyyymm", "active_days_bin")
            .agg(F.count_distinct("Contract").alias("distinct_contract_count"))
            .orderBy("month_yyyymm", active_days_bin_order("active_days_bin")))


def program_duration_stats(fact: DataFrame, month: str | None = None) -> DataFrame:
    """Per program: total seconds, hours, distinct watching contracts and their
    average active days. Watchers are contracts with a positive total.

    One scan. Rows are first reduced to one per (month, contract), where a contract that the fact repeats
    becomes one watcher; a fact that arrives partitioned by month and contract needs no exchange
    for that. The five programs stay columns up to the month's one row and are only then
    turned into rows. Each month has five rows (a program nobody watched has
    NULL totals and a zero count); with ``month=`` these five are there even if the
    fact holds no row of that month.
    """
    rows = _month(fact, month)
    watched = {p: F.col(p) > 0 for p in PROGRAM_TYPES}
    each = rows.groupBy("month_yyyymm", "Contract").agg(
        *[F.sum(F.when(w, F.col(p))).alias(f"{p}_total") for p, w in watched.items()],
        *[F.count_if(w).alias(f"{p}_rows") for p, w in watched.items()],
        *[F.sum(F.when(w, F.col("Active_Days"))).alias(f"{p}_days") for p, w in watched.items()],
        *[F.count(F.when(w, F.col("Active_Days"))).alias(f"{p}_known") for p, w in watched.items()])
    if month:        # a row that counts for nothing, so that the month is there
        each = each.unionByName(fact.sparkSession.createDataFrame([(month,)], "month_yyyymm string"),
                                allowMissingColumns=True)
    parts = each.groupBy("month_yyyymm").agg(*[
        F.struct(F.lit(p).alias("program_name"), F.sum(f"{p}_total").alias("total"),
                 F.count_if((F.col(f"{p}_rows") > 0) & F.col("Contract").isNotNull()).alias("contracts"),
                 F.sum(f"{p}_days").alias("days"), F.sum(f"{p}_known").alias("known")).alias(p) for p in PROGRAM_TYPES])
    long = parts.select("month_yyyymm", F.inline(F.array(*PROGRAM_TYPES)))
    return long.select("month_yyyymm", "program_name", F.col("total").alias("total_duration"),
                       (F.col("total") / 3600).alias("total_duration_hours"),
                       F.col("contracts").alias("distinct_contract_count"),
                       (F.col("days") / F.nullif("known", F.lit(0))).alias("avg_active_days"))


def taste_distribution(fact: DataFrame, month: str | None = None) -> DataFrame:
    """Distinct contracts per customer taste, largest first."""
    return (_month(fact, month).groupBy("month_yyyymm", "customer_taste")
            .agg(F.count_distinct("Contract").alias("distinct_contract_count"))
            .orderBy(F.col("month_yyyymm"), F.col("distinct_contract_count").desc(),
                     F.col("customer_taste")))


# --- parameterised top-k ---------------------------------------------------

TOP_SPREAD = 64      # parts of a month that are ranked before the month is


def _program_column(fact: DataFrame, program: str) -> DataFrame:
    return fact.select("month_yyyymm", "Contract", program_label(program).alias("Program"),
                       program_duration(program).alias("Duration"))


def top_contracts(fact: DataFrame, program: str, k: int = 10, month: str | None = None) -> DataFrame:
    """Top ``k`` contracts per month by the duration of ``program``.

    The program name is trimmed and lower-cased; ``tv``, ``tv channel``,
    ``tvchannel`` and ``tv_channel`` all mean TV_Channel, and an unknown name
    gives NULL durations (then the first ``k`` contracts by id). Ties go to the
    smaller contract id. One month is an order and a limit. All months are ranked
    twice, first within parts of a month and then the parts' winners, so the task
    of a month reads ``k`` rows of each part at most, whatever ``k`` is.
    """
    rows = _program_column(_month(fact, month), program)
    order = [F.col("Duration").desc_nulls_last(), F.col("Contract").asc()]
    if month:
        return rows.orderBy(*order).limit(k)
    part = F.pmod(F.xxhash64("Contract"), F.lit(TOP_SPREAD))
    for keys in (["month_yyyymm", "part"], ["month_yyyymm"]):
        if "part" in keys:
            rows = rows.withColumn("part", part)
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        rows = rows.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")
    return rows.drop("part")


def top_contracts_overall(fact: DataFrame, program: str, k: int = 10) -> DataFrame:
    """Top ``k`` rows of the whole fact, all months together (the call without a month)."""
    return (_program_column(fact, program)
            .orderBy(F.col("Duration").desc_nulls_last(), "Contract", "month_yyyymm").limit(k)
            .select("Contract", "Program", "Duration"))


# --- KPIs --------------------------------------------------------------------

def avg_total_devices(fact: DataFrame, month: str | None = None) -> DataFrame:
    """Average ``TotalDevices`` per month."""
    return (_month(fact, month).groupBy("month_yyyymm")
            .agg(F.avg("TotalDevices").alias("avg_total_devices")))


def behavior_sample(fact: DataFrame, n: int = 100) -> DataFrame:
    """A sample of ``n`` behaviour rows, deterministic: first by month and user."""
    return fact.orderBy("month_yyyymm", "user_id", "Previous_Genre", "Trending_Type").limit(n)


def genre_change_percent(fact: DataFrame, month: str | None = None) -> DataFrame:
    """Share of users whose genre changed, in percent with two decimals.
    (The reference calls this column ``percent_unchanged``; it is the changed
    share.) An empty month gives NULL instead of a division error."""
    changed = F.count_distinct(F.when(F.col("Trending_Type") != UNCHANGED, F.col("user_id")))
    users = F.count_distinct("user_id")
    pct = F.round(F.lit(Decimal("100.0")) * changed / F.nullif(users, F.lit(0)), 2).cast("double")
    return _month(fact, month).groupBy("month_yyyymm").agg(pct.alias("percent_changed"))


def changed_by_previous_genre(fact: DataFrame, month: str | None = None) -> DataFrame:
    """Users whose genre changed, per previous genre, largest first."""
    return (_month(fact, month).filter(F.col("Trending_Type") != UNCHANGED)
            .groupBy("month_yyyymm", "Previous_Genre")
            .agg(F.count_distinct("user_id").alias("changed_user_count"))
            .orderBy(F.col("month_yyyymm"), F.col("changed_user_count").desc(),
                     F.col("Previous_Genre")))


# --- dimensions --------------------------------------------------------------

def dim_user(behavior_fact: DataFrame) -> DataFrame:
    """Distinct non-NULL users of the behaviour fact."""
    return behavior_fact.select("user_id").filter(F.col("user_id").isNotNull()).distinct()


def dim_contract(interaction_fact: DataFrame) -> DataFrame:
    """Distinct non-NULL contracts of the interaction fact, as column ``contract``."""
    return (interaction_fact.select(F.col("Contract").alias("contract"))
            .filter(F.col("contract").isNotNull()).distinct())


# --- data-quality checks -----------------------------------------------------

def check_row_counts(interaction_fact: DataFrame, behavior_fact: DataFrame) -> DataFrame:
    """Row counts of both facts, one row."""
    a = interaction_fact.agg(F.count(F.lit(1)).alias("fact_interaction_rows"))
    b = behavior_fact.agg(F.count(F.lit(1)).alias("fact_behavior_rows"))
    return _one_row(a, b)


def check_dim_uniqueness(users: DataFrame, contracts: DataFrame) -> DataFrame:
    """Rows against distinct keys for both dimensions, one row."""
    u = users.agg(F.count(F.lit(1)).alias("dim_user_rows"),
                  F.count_distinct("user_id").alias("dim_user_distinct"))
    c = contracts.agg(F.count(F.lit(1)).alias("dim_contract_rows"),
                      F.count_distinct("contract").alias("dim_contract_distinct"))
    return _one_row(u, c)


def check_null_keys(behavior_fact: DataFrame, interaction_fact: DataFrame) -> DataFrame:
    """Rows with a NULL key in each fact, one row (NULL when a fact is empty)."""
    b = behavior_fact.agg(F.sum(F.when(F.col("user_id").isNull(), 1).otherwise(0))
                          .cast("bigint").alias("null_user_id_rows"))
    i = interaction_fact.agg(F.sum(F.when(F.col("Contract").isNull(), 1).otherwise(0))
                             .cast("bigint").alias("null_contract_rows"))
    return _one_row(b, i)


def _one_row(left: DataFrame, right: DataFrame) -> DataFrame:
    """Put two single-row global aggregates side by side without a join: stack
    them (each row has NULLs in the other's columns) and take the max per column."""
    stacked = left.unionByName(right, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in left.columns + right.columns])

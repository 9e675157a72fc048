"""Per-day state of the interaction fact, which merges to any month.

The month's fact is sums, a row count and a set of days per contract. Kept per (day, contract),
these merge: the month is the sum of its days' totals and counts and the OR of their
day bits. Stored by day, a late or corrected day replaces one partition, and the month is
rebuilt from thirty small partitions instead of from thirty days of raw logs.
(``TotalDevices`` counts log rows, which add up; distinct devices would not.)
"""

from __future__ import annotations

import calendar
from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchfold.functions.columns import app_category, month_of, valid_contract
from watchfold.functions.constants import WATCH_TYPES
from watchfold.operators.interaction import active_days_agg, fact_rows

STATE_COLUMNS = ["Contract", *WATCH_TYPES, "log_rows", "log_date"]


def daily_state(logs: DataFrame) -> DataFrame:
    """``Contract``, the total of each watch type (NULL if it has none), ``log_rows``, ``log_date``:
    one row per day and real contract, from one aggregation that is combined map-side."""
    rows = logs.filter(valid_contract("Contract") & F.col("log_date").isNotNull()) \
        .withColumn("Type", app_category("AppName"))
    return rows.groupBy("log_date", "Contract").agg(
        *[F.sum(F.when(F.col("Type") == t, F.col("TotalDuration"))).alias(t) for t in WATCH_TYPES],
        F.count(F.lit(1)).alias("log_rows")).select(*STATE_COLUMNS)


def fact_from_daily(state: DataFrame) -> DataFrame:
    """The interaction fact of every calendar month in ``state``. Several rows of a (day, contract), as
    from two loads of different logs of a day, add up."""
    tagged = state.withColumn("month_yyyymm", month_of("log_date"))
    return fact_rows(tagged.groupBy("month_yyyymm", "Contract").agg(
        *[F.sum(t).alias(t) for t in WATCH_TYPES], F.sum("log_rows").alias("TotalDevices"),
        active_days_agg().alias("Active_Days")))


def month_span(year: int, month: int) -> tuple[date, date]:
    return date(year, month, 1), date(year, month, calendar.monthrange(year, month)[1])


def within(state: DataFrame, spans: Iterable[tuple[date, date]]) -> DataFrame:
    """The state's rows of the given spans of days; on the stored table only these partitions are read."""
    return state.filter(reduce(or_, [F.col("log_date").between(F.lit(a), F.lit(b)) for a, b in spans], F.lit(False)))

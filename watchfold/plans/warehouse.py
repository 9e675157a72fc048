"""Storage side of the pipelines: monthly fact tables, dimensions, the bridge
table, the SQL views and the parameterised top-10 table function.

Facts are partitioned by ``month_yyyymm``. A run names its months and replaces exactly
those, also one that has become empty; it leaves the others alone, and running it again is
idempotent. (The reference deletes the month and then overwrites the whole table, which
kept only the last month.) Catalog tables are replaced by swapping staged partitions
(:mod:`watchfold.plans.publish`), path tables by dynamic partition overwrite.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchfold.functions.constants import (
    ACTIVE_DAY_BINS,
    ACTIVE_DAY_TOP_BIN,
    ACTIVE_DAY_UNKNOWN_BIN,
    PROGRAM_SYNONYMS,
    PROGRAM_TYPES,
)
from watchfold.operators import analytics, daily
from watchfold.operators.bridge import BRIDGE_SCHEMA, bridge_synth
from watchfold.plans import publish
from watchfold.plans.publish import LOAD_LOG_SCHEMA, MONTH, Check, CheckFailed, Load
from watchfold.sources import files

INTERACTION_TABLE = "fact_monthly_customer_interaction"
BEHAVIOR_TABLE = "fact_monthly_customer_behavior"
BRIDGE_TABLE = "user_contract_details"
LOAD_LOG = "load_log"
RAW_TABLE = "watch_log_raw"
DAILY_TABLE = "daily_contract_state"
DAILY_CHECKS = [publish.null_keys("Contract", "log_date")]
INTERACTION_CHECKS = [publish.null_keys("Contract"), Check("placeholder_contracts", "count_if(Contract IN ('', '0'))")]
BEHAVIOR_CHECKS = [publish.null_keys("user_id", "Trending_Type")]
TOP10_FUNCTION = "top10_contract_by_program"


@contextmanager
def _session_conf(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


# --- path-based facts (no catalog needed) --------------------------------------

def save_fact_to_path(fact: DataFrame, path: str, fmt: str = "parquet", months: Iterable[str] | None = None) -> Load:
    """Write a monthly fact under ``path``, replacing only its months: those named, or, without
    ``months``, those that come. A named month without rows is deleted; rows of a month not
    named are an error and nothing is replaced (a path has no catalog to swap: a reader of a month
    may meet it while it is replaced)."""
    path = path.rstrip("/")
    months = sorted(set(months)) if months is not None else None
    if months is not None:                     # other months must not be written at all
        named = F.coalesce(F.col(MONTH).isin(*months), F.lit(False))
        message = F.concat(F.lit("row of a month not named: "), F.coalesce(MONTH, F.lit("NULL")))
        fact = fact.withColumn(MONTH, F.when(named, F.col(MONTH)).otherwise(F.raise_error(message).cast("string")))
    load = publish.write_observed(
        fact, lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH).format(fmt).save(path))
    for month in set(months or ()) - set(load.months):
        publish.delete_folder(fact.sparkSession, publish.partition_folder(path, month))
    return load


def read_fact_from_path(spark: SparkSession, path: str, columns: list[str],
                        schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a fact written by :func:`save_fact_to_path`; the month stays a string."""
    reader = spark.read.format(fmt)
    if schema is None:
        reader = reader.option("basePath", path)
        with _session_conf(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
            frame = reader.load(path)
            frame = frame.select(*columns)
        return frame
    return reader.schema(schema).load(path).select(*columns)


# --- SQL text of the views and the table function -------------------------------

def _bin_case(column: str) -> str:
    parts = [f"WHEN {column} IS NULL THEN '{ACTIVE_DAY_UNKNOWN_BIN}'"]
    parts += [f"WHEN {column} >= {lo} AND {column} < {hi} THEN '{label}'"
              for lo, hi, label in ACTIVE_DAY_BINS]
    return "CASE " + " ".join(parts) + f" ELSE '{ACTIVE_DAY_TOP_BIN}' END"


def _bin_order_case(column: str) -> str:
    labels = [label for _, _, label in ACTIVE_DAY_BINS] + [ACTIVE_DAY_TOP_BIN]
    parts = [f"WHEN '{label}' THEN {pos}" for pos, label in enumerate(labels, start=1)]
    return f"CASE {column} " + " ".join(parts) + f" ELSE {len(labels) + 1} END"


def _program_case(param: str) -> str:
    by_column: dict[str, list[str]] = defaultdict(list)
    for synonym, column in PROGRAM_SYNONYMS.items():
        by_column[column].append(synonym)
    key = f"lower(trim({param}))"
    parts = [f"WHEN {key} IN ({', '.join(repr(s) for s in names)}) THEN {column}"
             for column, names in by_column.items()]
    return "CASE " + " ".join(parts) + " ELSE NULL END"


def view_queries(fact: str) -> dict[str, str]:
    """The SELECT of each of the three BI views over the table ``fact``, month-aware."""
    label = _bin_case("Active_Days")
    return {
        "vw_contract_active_days_distribution": f"""
SELECT {MONTH}, {label} AS active_days_bin, COUNT(DISTINCT Contract) AS distinct_contract_count
FROM {fact}
GROUP BY ALL
ORDER BY {MONTH}, {_bin_order_case('active_days_bin')}""",
        # one row per (month, contract), then one per month, then five
        "vw_program_duration_contract_stats": f"""
WITH each AS (
  SELECT {MONTH}, Contract, {', '.join(f"""SUM(CASE WHEN {p} > 0 THEN {p} END) AS {p}_total,
         COUNT_IF({p} > 0) AS {p}_rows, SUM(CASE WHEN {p} > 0 THEN Active_Days END) AS {p}_days,
         COUNT(CASE WHEN {p} > 0 THEN Active_Days END) AS {p}_known""" for p in PROGRAM_TYPES)}
  FROM {fact} GROUP BY {MONTH}, Contract),
months AS (
  SELECT {MONTH}, {', '.join(f"""SUM({p}_total) AS {p}_total, COUNT_IF({p}_rows > 0 AND Contract IS NOT NULL) AS {p}_contracts,
         SUM({p}_days) / NULLIF(SUM({p}_known), 0) AS {p}_average""" for p in PROGRAM_TYPES)}
  FROM each GROUP BY {MONTH})
SELECT {MONTH}, program_name, total_duration, total_duration / 3600 AS total_duration_hours,
       distinct_contract_count, avg_active_days
FROM months LATERAL VIEW stack({len(PROGRAM_TYPES)}, {', '.join(
    f"'{p}', {p}_total, {p}_contracts, {p}_average" for p in PROGRAM_TYPES)})
     AS program_name, total_duration, distinct_contract_count, avg_active_days""",
        "vw_customer_taste_contract_devices": f"""
SELECT {MONTH}, customer_taste, COUNT(DISTINCT Contract) AS distinct_contract_count
FROM {fact}
GROUP BY {MONTH}, customer_taste
ORDER BY {MONTH}, distinct_contract_count DESC, customer_taste""",
    }


def view_statements(schema: str) -> dict[str, str]:
    """``CREATE OR REPLACE VIEW`` statements of the three BI views."""
    return {name: f"CREATE OR REPLACE VIEW {schema}.{name} AS {query}"
            for name, query in view_queries(f"{schema}.{INTERACTION_TABLE}").items()}


def top10_function_statement(name: str, fact: str, temporary: bool = False) -> str:
    """SQL table function: top 10 contracts by a program's duration, of one month or, without
    the second argument, of the whole fact."""
    return f"""
CREATE OR REPLACE {'TEMPORARY ' if temporary else ''}FUNCTION {name}(program_name STRING, month STRING DEFAULT NULL)
RETURNS TABLE (Contract STRING, Program STRING, Duration BIGINT)
RETURN
  SELECT Contract, upper(trim(program_name)) AS Program, {_program_case('program_name')} AS Duration
  FROM {fact}
  WHERE month IS NULL OR {MONTH} = month
  ORDER BY Duration DESC NULLS LAST, Contract, {MONTH}
  LIMIT 10"""


# --- catalog-backed warehouse ----------------------------------------------------

class Warehouse:
    """The model's tables, views and function in one schema of the session catalog."""

    def __init__(self, spark: SparkSession, schema: str = "analytics", fmt: str = "parquet"):
        self.spark = spark
        self.schema = schema
        self.fmt = fmt

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def setup(self) -> None:
        """Create the schema if needed and make it current."""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema}")
        self.spark.sql(f"USE {self.schema}")

    # facts
    def save_fact(self, fact: DataFrame, table: str, months: Iterable[str] | None = None,
                  checks: Iterable[Check] = (), column: str = MONTH) -> Load:
        """Replace the months of a month-partitioned table (created if need be): those named, also
        if they have no rows any more, or, without ``months``, those that come.

        The rows are staged and checked as they are written; a check that fails leaves the table
        as it is (:class:`CheckFailed`). Each run is noted in the table ``load_log``.
        A column that the table lacks is added to it (NULL in the months before), one
        that the fact lacks is NULL in its months. ``column`` is the partition column."""
        name = self.name(table)
        if self.spark.catalog.tableExists(name):
            known = {c.lower() for c in self.spark.table(name).columns}
            new = [f for f in fact.schema.fields if f.name.lower() not in known]
            if new:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
                self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            own = {c.lower() for c in fact.columns}
            row = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name.lower() in own
                   else F.lit(None).cast(f.dataType).alias(f.name)
                   for f in self.spark.table(name).schema.fields]        # partition column last
            fact = fact.select(*row)
        else:
            self.spark.createDataFrame([], fact.schema).write.format(self.fmt).partitionBy(column).saveAsTable(name)
        return publish.publish(fact, name, months, checks, self.fmt,
                               lambda load, published: self._note(name, load, published), column)

    def _note(self, name: str, load: Load, published: bool) -> None:
        log = self.name(LOAD_LOG)
        if not self.spark.catalog.tableExists(log):
            self.spark.sql(f"CREATE TABLE {log} ({LOAD_LOG_SCHEMA}) USING {self.fmt}")
        publish.load_row(self.spark, name, load, published).coalesce(1).write.insertInto(log)

    def save_interaction_fact(self, fact: DataFrame, months: Iterable[str] | None = None) -> Load:
        return self.save_fact(fact, INTERACTION_TABLE, months, INTERACTION_CHECKS)

    def save_behavior_fact(self, fact: DataFrame, months: Iterable[str] | None = None) -> Load:
        return self.save_fact(fact, BEHAVIOR_TABLE, months, BEHAVIOR_CHECKS)

    # raw watch logs, every field and every line
    def save_raw_days(self, payloads: DataFrame, days: Iterable[date], max_malformed_share: float = 1.0) -> Load:
        """Replace the stored lines of the named days. Lines that are no JSON are stored too
        (:meth:`malformed_raw`); more than ``max_malformed_share`` of them publishes nothing."""
        share = "coalesce(count(malformed) / nullif(count(*), 0), 0.0)"
        checks = [Check("malformed_share", share, lambda v: float(v) <= max_malformed_share),
                  Check("malformed", "count(malformed)", lambda v: True)]
        return self.save_fact(payloads, RAW_TABLE, [d.isoformat() for d in days], checks, "log_date")

    def raw_logs(self, start: date, end: date, extra: dict[str, tuple[str, str]] | None = None) -> DataFrame:
        """Typed watch log rows of the stored days, with any ``extra`` fields of the payload."""
        stored = self.table(RAW_TABLE).filter(F.col("log_date").between(F.lit(start), F.lit(end)))
        return files.typed_watch_logs(stored, extra)

    def malformed_raw(self) -> DataFrame:
        return self.table(RAW_TABLE).filter(F.col("malformed").isNotNull()).select("log_date", "malformed")

    # per-day state of the interaction fact
    def save_days(self, state: DataFrame, days: Iterable[date]) -> Load:
        """Replace the stored state of the named days (also of days without rows)."""
        return self.save_fact(state, DAILY_TABLE, [d.isoformat() for d in days], DAILY_CHECKS, "log_date")

    def refresh_months(self, days: Iterable[date]) -> list[str]:
        """Rebuild the fact's months that the days lie in, from the stored state alone: only the
        partitions of those months are read."""
        months = sorted({(d.year, d.month) for d in days})
        spans = [daily.month_span(y, m) for y, m in months]
        state = daily.within(self.table(DAILY_TABLE), spans)
        names = [f"{y:04d}{m:02d}" for y, m in months]
        self.save_interaction_fact(daily.fact_from_daily(state), names)
        return names

    def vacuum(self, table: str) -> list[str]:
        """Delete the staged folders of ``table`` that are not in use any more."""
        return publish.vacuum(self.spark, self.name(table))

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    # dimensions
    def build_dimensions(self) -> None:
        """(Re)create ``dim_user`` and ``dim_contract`` from the facts."""
        analytics.dim_user(self.table(BEHAVIOR_TABLE)).write.mode("overwrite") \
            .format(self.fmt).saveAsTable(self.name("dim_user"))
        analytics.dim_contract(self.table(INTERACTION_TABLE)).write.mode("overwrite") \
            .format(self.fmt).saveAsTable(self.name("dim_contract"))

    # bridge
    def create_bridge_table(self) -> None:
        """Create the typed bridge table, or empty it; a table of other columns is replaced."""
        name, empty = self.name(BRIDGE_TABLE), self.spark.createDataFrame([], BRIDGE_SCHEMA)
        if self.spark.catalog.tableExists(name):
            if [(f.name, f.dataType) for f in self.spark.table(name).schema.fields] == \
                    [(f.name, f.dataType) for f in empty.schema.fields]:
                empty.write.insertInto(name, overwrite=True)
                return
            self.spark.sql(f"DROP TABLE {name}")
        self.spark.sql(f"CREATE TABLE {name} ({BRIDGE_SCHEMA}) USING {self.fmt}")

    def fill_bridge(self, seed: int = 42, **caps) -> DataFrame:
        """Synthesise bridge rows from the dimensions and overwrite the bridge table."""
        users = self.table("dim_user").select("user_id").dropna()
        contracts = self.table("dim_contract").select("contract").dropna()
        rows = bridge_synth(users, contracts, seed=seed, **caps)
        if not self.spark.catalog.tableExists(self.name(BRIDGE_TABLE)):
            self.create_bridge_table()
        rows.write.insertInto(self.name(BRIDGE_TABLE), overwrite=True)
        return self.table(BRIDGE_TABLE)

    # views and function
    def create_views(self) -> None:
        for statement in view_statements(self.schema).values():
            self.spark.sql(statement)

    def create_top10_function(self) -> None:
        self.spark.sql(top10_function_statement(f"{self.schema}.{TOP10_FUNCTION}", self.name(INTERACTION_TABLE)))

    def top10(self, program: str, month: str | None = None) -> DataFrame:
        """Call the table function (table functions resolve in the current schema, which is
        set back afterwards)."""
        before = self.spark.catalog.currentDatabase()
        self.spark.sql(f"USE {self.schema}")
        try:
            return self.spark.sql(f"SELECT * FROM {TOP10_FUNCTION}(:program, :month)",
                                  args={"program": program, "month": month})
        finally:
            self.spark.sql(f"USE {before}")

    # checks and reports on the stored tables
    def checks(self) -> dict[str, DataFrame]:
        behavior, interaction = self.table(BEHAVIOR_TABLE), self.table(INTERACTION_TABLE)
        return {"row_counts": analytics.check_row_counts(interaction, behavior),
                "dim_uniqueness": analytics.check_dim_uniqueness(self.table("dim_user"), self.table("dim_contract")),
                "null_keys": analytics.check_null_keys(behavior, interaction)}

    def report(self, program: str = "tv") -> dict[str, DataFrame]:
        behavior, interaction = self.table(BEHAVIOR_TABLE), self.table(INTERACTION_TABLE)
        views = {v: self.table(v) for v in view_queries("")}
        return {"top10": self.top10(program), **views,
                "avg_total_devices": analytics.avg_total_devices(interaction),
                "behavior_sample": analytics.behavior_sample(behavior),
                "genre_change_percent": analytics.genre_change_percent(behavior),
                "changed_by_previous_genre": analytics.changed_by_previous_genre(behavior)}

"""Named queries over the driver's tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads the whole tables (through the fixtures in
:mod:`watchfold.sources.fixtures`) and runs one operator, or a pipeline ending
in it. Queries that write something first do so under the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import suppress
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from watchfold.operators import analytics, behavior, bridge, daily, distinct, interaction, labelling, ledger
from watchfold.functions.columns import month_of, rule_genre
from watchfold.plans.warehouse import (
    BEHAVIOR_TABLE,
    BRIDGE_TABLE,
    INTERACTION_CHECKS,
    INTERACTION_TABLE,
    LOAD_LOG,
    CheckFailed,
    Warehouse,
    read_fact_from_path,
    save_fact_to_path,
    top10_function_statement,
    view_queries,
)
from watchfold.session import ensure_checkpoint_dir, scratch_path
from watchfold.sources import files
from watchfold.sources.fixtures import (
    DriverTables,
    genre_mapping_fixture,
    log_content_fixture,
    log_search_fixture,
)

Query = Callable[[SparkSession, str], DataFrame]

TOP_PROGRAM = "tv"       # the reference's example call of the top-10 report


# --- shared building blocks ----------------------------------------------------

def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_content_fixture(DriverTables(spark, sf_dir))


def _searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_search_fixture(DriverTables(spark, sf_dir))


def _mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genre_mapping_fixture(DriverTables(spark, sf_dir))


def fact_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.fact_interaction(_logs(spark, sf_dir))


def fact_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = DriverTables(spark, sf_dir)
    return behavior.fact_behavior(log_search_fixture(tables), genre_mapping_fixture(tables))


def _most_searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior.most_searched(_searches(spark, sf_dir))


def _genre_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = DriverTables(spark, sf_dir)
    return behavior.genre_mapped(behavior.most_searched(log_search_fixture(tables)),
                                 genre_mapping_fixture(tables))


def _durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.category_duration(_logs(spark, sf_dir))


def _programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior.distinct_programs(_most_searched(spark, sf_dir))


def fact_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the interaction fact twice into a month-partitioned table under the
    checkpoint folder (the second write replaces its month only) and read it back."""
    path = scratch_path(spark, "tables", f"fact_monthly_customer_interaction-{uuid.uuid4().hex}")
    fact = fact_interaction(spark, sf_dir)
    save_fact_to_path(fact, path)
    save_fact_to_path(fact, path)
    return read_fact_from_path(spark, path, interaction.FACT_COLUMNS, schema=fact.schema)


def _folder(spark: SparkSession, name: str) -> str:
    """A fresh folder whose name holds no digits (months are looked for in paths)."""
    word = "".join(chr(97 + int(c, 16)) for c in uuid.uuid4().hex)
    return scratch_path(spark, "tables", f"{name}-{word}")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "genres")
    files.write_genre_mapping(_mapping(spark, sf_dir), path)
    return files.read_genre_mapping(spark, path)


def watch_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watch log as one folder of JSON files per day, read back over its days."""
    path, logs = _folder(spark, "watch"), _logs(spark, sf_dir)
    inner = F.struct("Contract", "Mac", "AppName", "TotalDuration").alias("_source")
    day = F.concat(F.date_format("log_date", "yyyyMMdd"), F.lit(".json")).alias("day")
    logs.select(inner, day).write.partitionBy("day").json(path)
    first, last = logs.agg(F.min("log_date"), F.max("log_date")).first()
    return files.read_watch_logs(spark, path, first, last, missing="skip", name="day={day}.json")


def watch_log_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watch log as JSON files whose fields drift from day to day and hold lines that are no JSON,
    stored with every field; read back typed, with the unknown fields, and the malformed lines."""
    path, logs = _folder(spark, "payload"), _logs(spark, sf_dir)
    odd = F.dayofmonth("log_date") % 2 == 1
    inner = F.struct("Contract", "Mac", "AppName", "TotalDuration",
                     F.when(odd, F.struct(F.col("Mac").alias("id"), F.dayofyear("log_date").alias("os"))).alias("device"),
                     F.when(~odd, F.concat(F.lit("v"), F.dayofmonth("log_date"))).alias("release"))
    line = F.to_json(F.struct(F.lit("history").alias("_index"), inner.alias("_source")))
    broken = F.when(F.col("TotalDuration") == 0, F.concat(F.lit("{"), line)).otherwise(line)
    day = F.concat(F.date_format("log_date", "yyyyMMdd"), F.lit(".json")).alias("day")
    logs.select(broken.alias("value"), day).write.partitionBy("day").text(path)
    first, last = logs.agg(F.min("log_date"), F.max("log_date")).first()
    warehouse = _scratch_warehouse(spark)
    payloads = files.read_watch_payloads(spark, path, first, last, missing="skip", name="day={day}.json")
    warehouse.save_raw_days(payloads, [files.as_date(d) for d in files.day_paths(first, last)])
    extra = {"index_name": ("_index", "string"), "device_id": ("_source.device.id", "string"),
             "device_os": ("_source.device.os", "bigint"), "release": ("_source.release", "string")}
    good = warehouse.raw_logs(first, last, extra).withColumn("malformed", F.lit(None).cast("string"))
    return good.unionByName(warehouse.malformed_raw(), allowMissingColumns=True)


def search_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search log as a parquet tree by month, read back with the months of its paths."""
    path = _folder(spark, "search")
    tagged = _searches(spark, sf_dir).select("user_id", "keyword", month_of("log_date").alias("month"))
    tagged.write.partitionBy("month").parquet(path)
    return files.read_search_logs(spark, path)


def _fact_view(spark: SparkSession, sf_dir: str) -> str:
    name = "fact_" + uuid.uuid4().hex
    fact_interaction(spark, sf_dir).createOrReplaceTempView(name)
    return name


def sql_view(view: str) -> Query:
    return lambda spark, sf_dir: spark.sql(view_queries(_fact_view(spark, sf_dir))[view])


def sql_top10_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL table function, called with one argument."""
    fact = _fact_view(spark, sf_dir)
    spark.sql(top10_function_statement("top10_" + fact, fact, temporary=True))
    return spark.sql(f"SELECT * FROM top10_{fact}('{TOP_PROGRAM}')")


def rule_genre_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    keywords = (_searches(spark, sf_dir).select("keyword")
                .filter("keyword IS NOT NULL").distinct())
    return keywords.select("keyword", rule_genre("keyword").alias("Genre"))


def parse_label_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    replies = labelling.label_requests(_programs(spark, sf_dir)).checkpoint()
    return labelling.parse_label_replies(replies)


def _unavailable(keywords: list[str]) -> str:
    raise ConnectionError("labeller is down")


def label_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three labelling runs over one ledger: keywords of even length; those of odd length while the labeller
    is down; then all of them, which asks for the failed ones only. Genre and calls of each keyword."""
    ensure_checkpoint_dir(spark)
    path, programs = _folder(spark, "ledger"), _programs(spark, sf_dir).checkpoint()
    even = F.length("most_searched") % 2 == 0
    ledger.ask(programs.filter(even), path)
    ledger.ask(programs.filter(~even), path, _unavailable)
    ledger.ask(programs, path)
    calls = ledger.read_ledger(spark, path)
    return ledger.genres(programs, calls).join(ledger.times_asked(calls), "most_searched")


def bridge_synth(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The dimensions are materialised first (as the CTAS dimension tables are),
    # so the sampler's passes over them do not recompute the facts.
    ensure_checkpoint_dir(spark)
    users = analytics.dim_user(fact_behavior(spark, sf_dir)).checkpoint()
    contracts = analytics.dim_contract(fact_interaction(spark, sf_dir)).checkpoint()
    return bridge.bridge_synth(users, contracts)


def _scratch_warehouse(spark: SparkSession) -> Warehouse:
    """A warehouse in a schema of its own: a session's catalog may be gone while its folders are not."""
    warehouse = Warehouse(spark, "wf_" + uuid.uuid4().hex)
    spark.sql(f"CREATE SCHEMA {warehouse.schema}")
    return warehouse


def fact_month_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months published; then 202401 again with its active contracts only, and 202402 without rows."""
    warehouse, table = _scratch_warehouse(spark), "fact_" + uuid.uuid4().hex
    fact = fact_interaction(spark, sf_dir)
    warehouse.save_fact(fact, table, checks=INTERACTION_CHECKS)
    again = fact.filter("month_yyyymm = '202401' AND Active_Days >= 5")
    warehouse.save_fact(again, table, ["202401", "202402"], INTERACTION_CHECKS)
    warehouse.vacuum(table)
    return warehouse.table(table)


def publication_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the load log says of two loads: the fact, and one with its placeholder contracts left in,
    which the checks keep from being published."""
    warehouse, table = _scratch_warehouse(spark), "fact_" + uuid.uuid4().hex
    logs = _logs(spark, sf_dir)
    warehouse.save_fact(interaction.fact_interaction(logs), table, checks=INTERACTION_CHECKS)
    with suppress(CheckFailed):
        warehouse.save_fact(interaction.total_devices(logs), table, checks=INTERACTION_CHECKS)
    log = warehouse.table(LOAD_LOG).filter(F.col("table_name") == warehouse.name(table))
    values = F.from_json("metrics", "null_keys bigint, placeholder_contracts bigint")
    return log.select("rows", F.size("months").cast("bigint").alias("months"), values["null_keys"].alias("null_keys"),
                      values["placeholder_contracts"].alias("placeholder_contracts"), "published")


def fact_after_late_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days stored as state; then one day again, corrected (its short rows gone), and its month rebuilt
    from the stored days."""
    warehouse = _scratch_warehouse(spark)
    logs = _logs(spark, sf_dir)
    days = [r.log_date for r in logs.select("log_date").distinct().collect()]      # two or three months of days
    warehouse.save_days(daily.daily_state(logs), days)
    warehouse.refresh_months(days)
    late = date(2024, 1, 3)
    corrected = logs.filter((F.col("log_date") == F.lit(late)) & (F.col("TotalDuration") >= 5000))
    warehouse.save_days(daily.daily_state(corrected), [late])
    warehouse.refresh_months([late])
    return warehouse.table(INTERACTION_TABLE)


def contract_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps of the interaction fact, loaded in two parts and merged."""
    ensure_checkpoint_dir(spark)
    fact = fact_interaction(spark, sf_dir).checkpoint()
    known = distinct.numbered_dimension(fact.filter("month_yyyymm = '202401'"), "Contract")
    dimension = distinct.numbered_dimension(fact, "Contract", known)
    first, rest = fact.filter("month_yyyymm = '202401' OR Kids > 0"), fact.filter("month_yyyymm > '202401'")
    return distinct.merge(*(distinct.key_bitmaps(part, dimension, "Contract", distinct.interaction_measures())
                            for part in (first, rest)))


def user_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    fact = fact_behavior(spark, sf_dir).checkpoint()
    return distinct.key_bitmaps(fact, distinct.numbered_dimension(fact, "user_id"), "user_id",
                                distinct.behavior_measures())


def in_order(frame: DataFrame) -> DataFrame:
    """Add ``place``, each row's position in a sorted frame as it comes out, from 1.

    ``monotonically_increasing_id`` follows the partitions of the sort; a partition's offset is the
    number of rows before it (one row a partition)."""
    ensure_checkpoint_dir(frame.sparkSession)
    numbered = frame.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows")) \
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (numbered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn("place", F.col("_offset") + F.col("_id") - F.shiftleft("_part", 33) + 1)
            .drop("_part", "_id", "_offset"))


def programs_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct programs written as CSV and read back as text."""
    path = _folder(spark, "programs")
    files.export_programs(_programs(spark, sf_dir), path)
    return spark.read.schema("most_searched string").options(**files.CSV_READ).csv(path)


def stored_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts, dimensions and bridge as stored tables of one schema, with the rows and columns of each."""
    warehouse = _scratch_warehouse(spark)
    warehouse.save_interaction_fact(fact_interaction(spark, sf_dir))
    warehouse.save_behavior_fact(fact_behavior(spark, sf_dir))
    warehouse.build_dimensions()
    warehouse.create_bridge_table()
    warehouse.fill_bridge()
    tables = [INTERACTION_TABLE, BEHAVIOR_TABLE, "dim_user", "dim_contract", BRIDGE_TABLE]
    counted = [warehouse.table(t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                                      F.lit(", ".join(f"{c} {k}" for c, k in warehouse.table(t).dtypes)).alias("columns"))
               for t in tables]
    return reduce(DataFrame.unionByName, counted)


QUERIES: dict[str, Query] = {
    # sources (fixtures standing in for the log files)
    "log_content": _logs,
    "log_search": _searches,
    "genre_mapping": _mapping,
    # interaction fact and its operators
    "app_category": lambda s, d: interaction.categorized(_logs(s, d)),
    "category_duration": _durations,
    "contract_statistics": lambda s, d: interaction.contract_statistics(_durations(s, d)),
    "total_devices": lambda s, d: interaction.total_devices(_logs(s, d)),
    "most_watch": lambda s, d: interaction.most_watch(_durations(s, d)),
    "customer_taste": lambda s, d: interaction.customer_taste(_durations(s, d)),
    "daily_active": lambda s, d: interaction.daily_active(_logs(s, d)),
    "active_days": lambda s, d: interaction.active_days(_logs(s, d)),
    "fact_interaction": fact_interaction,
    "fact_interaction_stepwise": lambda s, d: interaction.fact_interaction_stepwise(_logs(s, d)),
    "fact_sink_roundtrip": fact_sink_roundtrip,
    "daily_state": lambda s, d: daily.daily_state(_logs(s, d)),
    "fact_from_daily": lambda s, d: daily.fact_from_daily(daily.daily_state(_logs(s, d))),
    "fact_after_late_day": fact_after_late_day,
    # behaviour fact and its operators
    "keyword_frequency": lambda s, d: behavior.keyword_frequency(_searches(s, d)),
    "most_searched": _most_searched,
    "genre_mapped": _genre_mapped,
    "genre_trend": lambda s, d: behavior.genre_trend(_genre_mapped(s, d)),
    "fact_behavior": fact_behavior,
    "distinct_programs": _programs,
    # views, report, KPIs
    "active_days_distribution": lambda s, d: analytics.active_days_distribution(fact_interaction(s, d)),
    "program_duration_stats": lambda s, d: analytics.program_duration_stats(fact_interaction(s, d)),
    "taste_distribution": lambda s, d: analytics.taste_distribution(fact_interaction(s, d)),
    "top10_by_program": lambda s, d: analytics.top_contracts(fact_interaction(s, d), TOP_PROGRAM, 10),
    "avg_total_devices": lambda s, d: analytics.avg_total_devices(fact_interaction(s, d)),
    "behavior_sample": lambda s, d: analytics.behavior_sample(fact_behavior(s, d), 100),
    "genre_change_percent": lambda s, d: analytics.genre_change_percent(fact_behavior(s, d)),
    "changed_by_previous_genre": lambda s, d: analytics.changed_by_previous_genre(fact_behavior(s, d)),
    # dimensions and checks
    "dim_user": lambda s, d: analytics.dim_user(fact_behavior(s, d)),
    "dim_contract": lambda s, d: analytics.dim_contract(fact_interaction(s, d)),
    "check_row_counts": lambda s, d: analytics.check_row_counts(fact_interaction(s, d),
                                                                fact_behavior(s, d)),
    # on the facts' key columns as they are (repeated keys), and on the raw logs (NULL keys)
    "check_dim_uniqueness": lambda s, d: analytics.check_dim_uniqueness(
        fact_behavior(s, d).select("user_id"),
        fact_interaction(s, d).select(F.col("Contract").alias("contract"))),
    "check_null_keys": lambda s, d: analytics.check_null_keys(_searches(s, d), _logs(s, d)),
    "top10_overall": lambda s, d: analytics.top_contracts_overall(fact_interaction(s, d), TOP_PROGRAM, 10),
    # SQL text
    "sql_active_days_view": sql_view("vw_contract_active_days_distribution"),
    "sql_program_stats_view": sql_view("vw_program_duration_contract_stats"),
    "sql_taste_view": sql_view("vw_customer_taste_contract_devices"),
    "sql_top10_function": sql_top10_function,
    # files written and read back
    "csv_roundtrip": csv_roundtrip,
    "watch_log_files": watch_log_files,
    "watch_log_payloads": watch_log_payloads,
    "search_log_files": search_log_files,
    # bridge
    "bridge_synth": bridge_synth,
    # labelling
    "label_genres": lambda s, d: labelling.label_genres(_programs(s, d)),
    "parse_label_replies": parse_label_replies,
    "label_ledger": label_ledger,
    "rule_genre_label": rule_genre_label,
    "check_genre_domain": lambda s, d: labelling.check_genre_domain(_mapping(s, d)),
    # months replaced, checks taken during the write, the stored model
    "fact_month_reload": fact_month_reload,
    "publication_checks": publication_checks,
    "programs_csv": programs_csv,
    "stored_model": stored_model,
    # distinct counts from mergeable bitmaps
    "bitmap_active_days": lambda s, d: distinct.active_days_distribution(contract_bitmaps(s, d)),
    "bitmap_taste": lambda s, d: distinct.taste_distribution(contract_bitmaps(s, d)),
    "bitmap_genre_change": lambda s, d: distinct.genre_change_percent(user_bitmaps(s, d)),
    "bitmap_program_reach": lambda s, d: distinct.program_reach(contract_bitmaps(s, d)),
    "bitmap_taste_reach": lambda s, d: distinct.taste_reach(contract_bitmaps(s, d)),
    "bitmap_retention": lambda s, d: distinct.retention(user_bitmaps(s, d)),
    # presentation orders, with the place of each row as it comes out
    "active_days_in_order": lambda s, d: in_order(analytics.active_days_distribution(fact_interaction(s, d))),
    "taste_in_order": lambda s, d: in_order(analytics.taste_distribution(fact_interaction(s, d))),
    "changed_in_order": lambda s, d: in_order(analytics.changed_by_previous_genre(fact_behavior(s, d))),
    "users_in_order": lambda s, d: in_order(behavior.order_users_desc(analytics.dim_user(fact_behavior(s, d)))),
}

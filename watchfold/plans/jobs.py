"""The reference's runnable jobs, end to end on files and the catalog.

* ``interaction`` — daily JSON watch logs of a date range -> interaction fact;
* ``ingest``      — the daily logs stored with every field, malformed lines beside them;
* ``days``        — the same logs day by day: per-day state stored, its months rebuilt from it;
* ``behavior``    — search logs of two months + genre CSV -> behaviour fact;
* ``label``       — distinct most-searched keywords of two months -> genre CSV;
* ``model``       — dimensions, bridge table and rows, views, top-10 function;
* ``export``      — distinct most-searched keywords of two months -> CSV;
* ``checks``      — row counts, dimension uniqueness, NULL keys of the stored tables;
* ``report``      — top 10, the three views and the KPIs over the stored tables.

    python -m watchfold.plans.jobs interaction --input s3a://.../log_content --start 20220401 --end 20220430
    python -m watchfold.plans.jobs behavior --input .../log_search --previous 202206 --current 202207 \\
        --mapping .../genres_csv
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession

from watchfold.operators import daily, ledger
from watchfold.operators.behavior import distinct_programs, fact_behavior_between, most_searched
from watchfold.operators.interaction import fact_interaction, months_between
from watchfold.operators.labelling import Labeller, label_genres
from watchfold.plans.warehouse import RAW_TABLE, Warehouse
from watchfold.session import build_session, ensure_checkpoint_dir
from watchfold.sources.files import (
    as_date,
    day_paths,
    export_programs,
    read_genre_mapping,
    read_search_logs,
    read_watch_logs,
    read_watch_payloads,
    write_genre_mapping,
)

MAX_FAILED_SHARE = 0.1      # of labeller calls


def run_interaction_etl(spark: SparkSession, input_root: str, start: str, end: str,
                        warehouse: Warehouse, missing: str = "fail",
                        per_calendar_month: bool = False, from_raw: bool = False) -> DataFrame:
    """Read the days ``start..end`` in one scan, build the fact, write its month. ``from_raw`` reads
    the days that :func:`run_ingest` has stored instead of the files.

    The whole run is tagged with the month of ``start`` (the reference's rule);
    ``per_calendar_month=True`` tags each day with its own month instead.
    """
    logs = warehouse.raw_logs(as_date(start), as_date(end)) if from_raw else \
        read_watch_logs(spark, input_root, start, end, missing)
    if per_calendar_month:
        fact = fact_interaction(logs)
        months = [f"{y:04d}{m:02d}" for y, m in months_between(as_date(start), as_date(end))]
    else:     # every row lies in start..end, so active days can use the day mask
        fact = fact_interaction(logs, month=start[:6], window=(as_date(start), as_date(end)))
        months = [start[:6]]
    warehouse.save_interaction_fact(fact, months)
    return warehouse.table("fact_monthly_customer_interaction")


def run_ingest(spark: SparkSession, input_root: str, start: str, end: str, warehouse: Warehouse,
               missing: str = "fail", max_malformed_share: float = 1.0) -> DataFrame:
    """Store every line of the days ``start..end`` with all its fields, in one scan; lines that are no
    JSON are kept beside them and counted in the load log."""
    payloads = read_watch_payloads(spark, input_root, start, end, missing)
    warehouse.save_raw_days(payloads, [as_date(d) for d in day_paths(start, end)], max_malformed_share)
    return warehouse.table(RAW_TABLE)


def run_daily_etl(spark: SparkSession, input_root: str, start: str, end: str, warehouse: Warehouse,
                  missing: str = "fail") -> DataFrame:
    """Read the days ``start..end``, replace their stored state, and rebuild the calendar months they lie
    in from the state of all their days. A late or corrected day costs its own logs only."""
    state = daily.daily_state(read_watch_logs(spark, input_root, start, end, missing))
    days = [as_date(d) for d in day_paths(start, end)]
    warehouse.save_days(state, days)
    warehouse.refresh_months(days)
    return warehouse.table("fact_monthly_customer_interaction")


def run_behavior_etl(spark: SparkSession, input_root: str, previous_month: str, current_month: str,
                     mapping_path: str, warehouse: Warehouse) -> DataFrame:
    """Most searched keyword per user in both months, genres, trend; write the current month."""
    searches = read_search_logs(spark, input_root, [previous_month, current_month])
    mapping = read_genre_mapping(spark, mapping_path)
    fact = fact_behavior_between(searches, mapping, previous_month, current_month)
    warehouse.save_behavior_fact(fact, [current_month])
    return warehouse.table("fact_monthly_customer_behavior")


def run_labelling(spark: SparkSession, input_root: str, previous_month: str, current_month: str,
                  output_path: str, labeller: Labeller | None = None, parallelism: int | None = None,
                  max_failed_share: float = MAX_FAILED_SHARE, ledger_path: str | None = None) -> DataFrame:
    """Label the distinct most-searched keywords of both months; write the genre CSV. If more
    than ``max_failed_share`` of the labeller's calls fail, no CSV is written. With ``ledger_path``
    all calls are kept there, and only keywords without an answer in it are asked for."""
    searches = read_search_logs(spark, input_root, [previous_month, current_month])
    programs = distinct_programs(most_searched(searches))
    if ledger_path is None:
        labels = label_genres(programs, labeller, parallelism=parallelism, max_failed_share=max_failed_share)
    else:
        ensure_checkpoint_dir(spark)
        programs = programs.checkpoint()                     # the waves would read the log again
        run = ledger.ask(programs, ledger_path, labeller, parallelism=parallelism)
        calls = ledger.read_ledger(spark, ledger_path)
        ledger.check_run(calls, run, max_failed_share)
        labels = ledger.genres(programs, calls)
    write_genre_mapping(labels, output_path)
    return read_genre_mapping(spark, output_path)


def load_labeller(name: str) -> Labeller:
    """The function a ``module:function`` name stands for."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def run_export(spark: SparkSession, input_root: str, previous_month: str, current_month: str,
               output_path: str) -> DataFrame:
    """Write the distinct most-searched keywords of both months as CSV, from one read of the logs."""
    top = most_searched(read_search_logs(spark, input_root, [previous_month, current_month]))
    return export_programs(distinct_programs(top), output_path)


def run_model(warehouse: Warehouse, seed: int = 42) -> None:
    """Dimensions, bridge table (typed, then filled), views and the top-10 function."""
    warehouse.setup()
    warehouse.build_dimensions()
    warehouse.create_bridge_table()
    warehouse.fill_bridge(seed=seed)
    warehouse.create_views()
    warehouse.create_top10_function()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="watchfold.plans.jobs")
    parser.add_argument("--schema", default="analytics")
    parser.add_argument("--format", default="parquet")
    sub = parser.add_subparsers(dest="job", required=True)
    for name in ("interaction", "days", "ingest"):
        p = sub.add_parser(name)
        p.add_argument("--input", required=True)
        p.add_argument("--start", required=True)
        p.add_argument("--end", required=True)
        p.add_argument("--missing", choices=["fail", "skip"], default="fail")
        if name == "interaction":
            p.add_argument("--from-raw", action="store_true", help="read what ingest has stored")
        if name == "ingest":
            p.add_argument("--max-malformed-share", type=float, default=1.0)
    for name in ("behavior", "label", "export"):
        p = sub.add_parser(name)
        p.add_argument("--input", required=True)
        p.add_argument("--previous", required=True)
        p.add_argument("--current", required=True)
        p.add_argument("--mapping" if name == "behavior" else "--output", required=True)
        if name == "label":
            p.add_argument("--labeller", help="module:function, called with a list of keywords")
            p.add_argument("--parallelism", type=int)
            p.add_argument("--ledger", help="folder of the labeller's calls; answered keywords are not asked again")
            p.add_argument("--max-failed-share", type=float, default=MAX_FAILED_SHARE)
    for name in ("checks", "report"):
        sub.add_parser(name)
    p = sub.add_parser("model")
    p.add_argument("--seed", type=int, default=42)
    args = parser.parse_args(argv)

    spark = build_session(app_name=f"watchfold-{args.job}")
    warehouse = Warehouse(spark, args.schema, args.format)
    warehouse.setup()
    if args.job == "interaction":
        run_interaction_etl(spark, args.input, args.start, args.end, warehouse, args.missing, from_raw=args.from_raw)
    elif args.job == "ingest":
        run_ingest(spark, args.input, args.start, args.end, warehouse, args.missing, args.max_malformed_share)
    elif args.job == "days":
        run_daily_etl(spark, args.input, args.start, args.end, warehouse, args.missing)
    elif args.job == "behavior":
        run_behavior_etl(spark, args.input, args.previous, args.current, args.mapping, warehouse)
    elif args.job == "label":
        labeller = load_labeller(args.labeller) if args.labeller else None
        run_labelling(spark, args.input, args.previous, args.current, args.output, labeller,
                      args.parallelism, args.max_failed_share, args.ledger)
    elif args.job == "export":
        run_export(spark, args.input, args.previous, args.current, args.output)
    elif args.job in ("checks", "report"):
        for name, frame in getattr(warehouse, args.job)().items():
            print(name)
            frame.show(100, truncate=False)
    else:
        run_model(warehouse, args.seed)


if __name__ == "__main__":
    main()

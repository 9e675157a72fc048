"""Publication of months (or days): stage, check while writing, then swap partition locations.

A run names the months it loads. Its rows are written once, into a folder of the
run's own under the table (``_runs/<id>/month_yyyymm=...``), where no reader looks.
Aggregates over exactly the rows written are taken by that same job (``Observation``), so
the checks cost no second scan. Only if all hold does each named month's partition get its new
location, one catalog operation a month: a reader sees the old month or the new one,
never a mixture or a gap. A named month without rows points to an empty folder afterwards, so
what was there before is gone; a month that was not named is an error, and stays as it is.

Folders that no partition points to any more are kept for readers that still use them, until
:func:`vacuum`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MONTH = "month_yyyymm"
RUNS = "_runs"
LOAD_LOG_SCHEMA = ("table_name string, run_id string, months array<string>, rows bigint, metrics string, "
                   "failed array<string>, published boolean")


class CheckFailed(ValueError):
    """A check on the rows as written did not hold; nothing was published."""


@dataclass(frozen=True)
class Check:
    """An aggregate over the written rows (SQL) and what it must satisfy."""

    name: str
    value: str
    holds: Callable[[Any], bool] = field(default=lambda v: v == 0)


def null_keys(*keys: str) -> Check:
    """No row has a NULL in a key column."""
    return Check("null_keys", "count_if(" + " OR ".join(f"`{k}` IS NULL" for k in keys) + ")")


def at_least(rows: int) -> Check:
    return Check("enough_rows", "count(*)", lambda n: n >= rows)


@dataclass(frozen=True)
class Load:
    """What a run wrote: its id, rows, the months that had rows, and each check's value."""

    run_id: str
    months: list[str]
    rows: int
    metrics: dict[str, Any]
    failed: list[str]


# --- folders ---------------------------------------------------------------------

def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.mkdirs(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    target, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


# --- staging ---------------------------------------------------------------------

def write_observed(rows: DataFrame, save: Callable[[DataFrame], None], months: Iterable[str] | None = None,
                   checks: Iterable[Check] = (), column: str = MONTH) -> Load:
    """Write ``rows`` by ``save`` and take months (values of the partition column, as text), row
    count and checks from that job."""
    checks = list(checks)
    if months is not None:
        named = ", ".join(repr(m) for m in months) or "NULL"
        checks.append(Check("rows_of_other_months", f"count_if(coalesce(CAST({column} AS STRING) NOT IN ({named}), true))"))
    seen = Observation()
    # numbered, as a caller's check names may clash with each other or with columns
    values = [F.expr(c.value).alias(f"check_{k}") for k, c in enumerate(checks)]
    save(rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(column).cast("string")).alias("months"), *values))
    got = seen.get
    metrics = {c.name: got.get(f"check_{k}", 0) for k, c in enumerate(checks)}
    return Load(uuid.uuid4().hex, sorted(got.get("months") or []), got.get("rows") or 0, metrics,
                [c.name for c in checks if not c.holds(metrics[c.name])])


def table_folder(spark: SparkSession, table: str) -> str:
    detail = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()
    return detail.data_type.rstrip("/")


def partition_folder(base: str, month: str, column: str = MONTH) -> str:
    return f"{base}/{column}={month}"


def published_months(spark: SparkSession, table: str) -> list[str]:
    return sorted(r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def publish(rows: DataFrame, table: str, months: Iterable[str] | None = None, checks: Iterable[Check] = (),
            fmt: str = "parquet", note: Callable[[Load, bool], None] | None = None, column: str = MONTH) -> Load:
    """Replace months of ``table`` (partitioned by ``month_yyyymm``, or by another ``column`` of which the
    "months" are values; columns as ``rows``).

    ``months`` are the months the run is about; without it, those that come. ``note`` is told of
    every run, also of one that is not published.
    """
    spark = rows.sparkSession
    months = sorted(set(months)) if months is not None else None
    staged = f"{table_folder(spark, table)}/{RUNS}/{uuid.uuid4().hex}"
    load = write_observed(rows, lambda df: df.write.partitionBy(column).format(fmt).save(staged), months, checks,
                          column)
    if load.failed:
        delete_folder(spark, staged)
        if note:
            note(load, False)
        raise CheckFailed(f"{table}: " + ", ".join(f"{name} = {load.metrics[name]}" for name in load.failed))
    there = set(published_months(spark, table))
    for month in months if months is not None else load.months:
        folder, spec = partition_folder(staged, month, column), f"PARTITION ({column} = '{month}')"
        if month not in load.months:
            if month not in there:
                continue
            make_folder(spark, folder)
        if month in there:
            spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{folder}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD {spec} LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    if note:
        note(load, True)
    return load


def vacuum(spark: SparkSession, table: str) -> list[str]:
    """Delete the runs that no partition of ``table`` points to; returns their ids. Call it when no
    reader started before the last publication is left."""
    base = f"{table_folder(spark, table)}/{RUNS}"
    used = set()
    for spec in (r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()):
        name, value = spec.split("=", 1)
        rows = spark.sql(f"DESCRIBE FORMATTED {table} PARTITION ({name} = '{value}')").filter("col_name = 'Location'")
        used.add(rows.first().data_type.rstrip("/").split("/")[-2])
    gone = [run for run in list_folders(spark, base) if run not in used]
    for run in gone:
        delete_folder(spark, f"{base}/{run}")
    return gone


def load_row(spark: SparkSession, table: str, load: Load, published: bool) -> DataFrame:
    return spark.createDataFrame([(table, load.run_id, load.months, load.rows, json.dumps(load.metrics, default=str),
                                   load.failed, published)], LOAD_LOG_SCHEMA)

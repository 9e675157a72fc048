"""File sources and sinks of the pipelines.

* watch logs: one JSON-lines file per day, ``<yyyymmdd>.json``, payload in ``_source``;
* search logs: a parquet tree whose paths carry the month ``yyyymm``;
* genre mapping: CSV with header ``most_searched,Genre``.

Schemas are always given, never inferred: a day with a missing or reordered
field cannot shift columns, and no extra job runs for inference.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WATCH_LOG_SCHEMA = T.StructType([
    T.StructField("_source", T.StructType([
        T.StructField("Contract", T.StringType()),
        T.StructField("Mac", T.StringType()),
        T.StructField("AppName", T.StringType()),
        T.StructField("TotalDuration", T.StringType()),    # a number of any kind, or quoted
    ])),
    T.StructField("_malformed", T.StringType()),
])

SEARCH_LOG_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("keyword", T.StringType()),
])

GENRE_MAPPING_SCHEMA = T.StructType([
    T.StructField("most_searched", T.StringType()),
    T.StructField("Genre", T.StringType()),
])

_MONTH_IN_PATH = r"((?:19|20)[0-9]{2}(?:0[1-9]|1[0-2]))"


def as_date(d: str | date) -> date:
    if isinstance(d, date):
        return d
    return datetime.strptime(d, "%Y%m%d").date()


def day_paths(start: str | date, end: str | date) -> list[str]:
    """``yyyymmdd`` for every day from ``start`` to ``end``, both included."""
    first, last = as_date(start), as_date(end)
    return [(first + timedelta(days=i)).strftime("%Y%m%d") for i in range((last - first).days + 1)]


def _day_files(root: str, start: str | date, end: str | date, missing: str, name: str) -> list[str]:
    """Paths of the days' files: each by name (an absent day fails), or one brace glob over them."""
    days, base = day_paths(start, end), root.rstrip("/")
    if missing == "fail":
        return [f"{base}/{name.format(day=d)}" for d in days]
    if missing == "skip":
        return [f"{base}/{name.format(day='{' + ','.join(days) + '}')}"]
    raise ValueError("missing must be 'fail' or 'skip'")


def _day_of_path() -> Column:
    """The day of the ``<yyyymmdd>.json`` path element: a file, or a folder of part files."""
    return F.to_date(F.regexp_extract(F.col("_metadata.file_path"), r"([0-9]{8})\.json", 1), "yyyyMMdd")


def _watch_lines(spark: SparkSession, root: str, start: str | date, end: str | date,
                 missing: str, name: str) -> DataFrame:
    reader = spark.read.schema(WATCH_LOG_SCHEMA).option("columnNameOfCorruptRecord", "_malformed")
    return reader.json(_day_files(root, start, end, missing, name)).withColumn("log_date", _day_of_path())


def read_watch_logs(spark: SparkSession, root: str, start: str | date, end: str | date,
                    missing: str = "fail", name: str = "{day}.json") -> DataFrame:
    """All daily watch logs from ``start`` to ``end`` in one scan.

    Returns ``Contract, Mac, AppName, TotalDuration, log_date``; the date comes
    from the ``<yyyymmdd>.json`` element of each row's path (``_metadata`` column).
    ``TotalDuration`` is a double, so that whole, fractional and quoted numbers all
    count. ``missing="fail"`` fails on an absent day like the reference does;
    ``missing="skip"`` reads the days that exist (a brace glob over the day names).
    Lines that are no JSON are left out here and counted by :func:`malformed_lines`; with
    :func:`read_watch_payloads` they are kept, and so are all other fields.
    """
    raw = _watch_lines(spark, root, start, end, missing, name).filter(F.col("_malformed").isNull())
    return raw.select(
        F.col("_source.Contract").alias("Contract"),
        F.col("_source.Mac").alias("Mac"),
        F.col("_source.AppName").alias("AppName"),
        F.expr("try_cast(_source.TotalDuration AS DOUBLE)").alias("TotalDuration"),
        "log_date",
    )


def malformed_lines(spark: SparkSession, root: str, start: str | date, end: str | date,
                    missing: str = "fail", name: str = "{day}.json") -> DataFrame:
    """``log_date, lines, malformed``: lines of each day and how many are no JSON, or carry a
    duration that is no number."""
    lines = _watch_lines(spark, root, start, end, missing, name)
    duration = F.col("_source.TotalDuration")
    bad = F.col("_malformed").isNotNull() | (
        duration.isNotNull() & F.expr("try_cast(_source.TotalDuration AS DOUBLE)").isNull())
    return lines.groupBy("log_date").agg(F.count("*").alias("lines"), F.count(F.when(bad, 1)).alias("malformed"))


# --- watch logs with every field --------------------------------------------------

def read_watch_payloads(spark: SparkSession, root: str, start: str | date, end: str | date,
                        missing: str = "fail", name: str = "{day}.json") -> DataFrame:
    """Every line of the daily watch logs, with all its fields, in one scan.

    Returns ``payload`` (the line's JSON object as VARIANT), ``malformed`` (the line itself, if it is no JSON
    object; then ``payload`` is NULL) and ``log_date``. Blank lines are no lines. Nothing else is dropped:
    fields may come, go or change type from day to day.
    """
    lines = spark.read.text(_day_files(root, start, end, missing, name))
    parsed = F.try_parse_json("value")
    kept = F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed)
    return (lines.filter(F.trim(F.regexp_replace("value", "[\\r\\t]", " ")) != "")
            .select(kept.alias("payload"), F.col("value"), _day_of_path().alias("log_date"))
            .select("payload", F.when(F.col("payload").isNull(), F.col("value")).alias("malformed"), "log_date"))


def payload_field(path: str, kind: str = "string") -> Column:
    """A field of the payload, e.g. ``_source.Mac``; NULL where it is missing or not of that kind."""
    return F.try_variant_get("payload", "$." + path, kind)


def typed_watch_logs(payloads: DataFrame, extra: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``Contract, Mac, AppName, TotalDuration, log_date`` of the well-formed lines, as
    :func:`read_watch_logs` gives them; ``extra`` adds columns, name -> (path, type)."""
    more = [payload_field(path, kind).alias(column) for column, (path, kind) in (extra or {}).items()]
    return payloads.filter(F.col("payload").isNotNull()).select(
        *[payload_field(f"_source.{c}").alias(c) for c in ("Contract", "Mac", "AppName")],
        payload_field("_source.TotalDuration", "double").alias("TotalDuration"), *more, "log_date")


def payload_schemas(payloads: DataFrame) -> DataFrame:
    """``log_date, lines, malformed, schema``: lines of each day, how many are no JSON object, and the
    schema that all its objects have in common (types that differ within a day become VARIANT)."""
    return payloads.groupBy("log_date").agg(F.count(F.lit(1)).alias("lines"), F.count("malformed").alias("malformed"),
                                            F.schema_of_variant_agg("payload").alias("schema"))


def read_search_logs(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    """Search logs under ``root`` (searched recursively) as ``user_id, keyword, month_yyyymm``.

    With ``months``, only files whose full path contains one of them are read
    (the filter on ``_metadata.file_path`` prunes files before the scan); a file whose
    path contains several of them is read for each. Without it, every file is read and
    tagged with the first ``yyyymm`` in its path; a path without one is an error. No
    matching file gives an empty frame with the same schema.
    """
    raw = (spark.read.schema(SEARCH_LOG_SCHEMA)
           .option("recursiveFileLookup", "true")
           .option("pathGlobFilter", "*.parquet")
           .parquet(root))
    path = F.col("_metadata.file_path")
    if months:
        raw = raw.filter(reduce(lambda a, b: a | b, [path.contains(m) for m in months]))
        found = F.filter(F.array(*[F.lit(m) for m in months]), lambda m: F.contains(path, m))
        return raw.select("user_id", "keyword", F.explode(found).alias("month_yyyymm"))
    found = F.regexp_extract(path, _MONTH_IN_PATH, 1)
    tag = F.when(found != "", found).otherwise(F.raise_error(F.concat(F.lit("no yyyymm in "), path)).cast("string"))
    return raw.select("user_id", "keyword", tag.alias("month_yyyymm"))


# Standard CSV: quotes doubled, line breaks inside quotes, white space and "" kept apart from NULL.
# (the reader takes its empty value for NULL, so "" is read as a character and put back).
EMPTY = "\x00"
CSV_READ = {"header": "true", "escape": '"', "multiLine": "true", "emptyValue": EMPTY,
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_WRITE = {"header": "true", "escape": '"', "emptyValue": '""',
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_genre_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The keyword -> genre CSV (header line, all strings)."""
    raw = spark.read.schema(GENRE_MAPPING_SCHEMA).options(**CSV_READ).csv(path)
    return raw.select(*[F.when(F.col(c) == EMPTY, "").otherwise(F.col(c)).alias(c) for c in raw.columns])


def write_genre_mapping(mapping: DataFrame, path: str) -> None:
    """Write a keyword -> genre mapping as CSV with header (a folder of part files)."""
    (mapping.select("most_searched", "Genre")
     .write.mode("overwrite").options(**CSV_WRITE).csv(path))


def export_programs(programs: DataFrame, path: str) -> DataFrame:
    """Write keywords ``most_searched`` as CSV; returns them."""
    programs.write.mode("overwrite").options(**CSV_WRITE).csv(path)
    return programs


def export_distinct_programs(previous: DataFrame, current: DataFrame, path: str) -> DataFrame:
    """Write the distinct most-searched keywords of two periods as CSV; returns them."""
    return export_programs(previous.select("most_searched").unionByName(current.select("most_searched")).distinct(), path)

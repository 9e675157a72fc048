"""Labelling with a ledger of the labeller's calls.

Calls to a labelling service cost money and fail. Every call is appended to a ledger (its
keywords, the reply or the error, the run, the time), and a run asks only for keywords that
no successful call and no stored mapping has answered: a left-anti join before the calls. A rerun after a
success makes no call at all; a rerun after failures asks for the failed keywords alone. Calls are
made in waves, each appended when it is done, so a job that is lost costs the calls of
one wave at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold.functions.constants import DEFAULT_GENRE, LABEL_BATCH_SIZE
from watchfold.operators.labelling import Labeller, LabellingFailed, label_requests, parse_label_replies

LEDGER_SCHEMA = "keywords array<string>, reply string, error string, run_id string, called_at timestamp"
WAVES = 8


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All calls so far; none if there is no ledger yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def answered(ledger: DataFrame) -> DataFrame:
    """Keywords that a call has been answered for, whatever the reply says of them."""
    return ledger.filter(F.col("error").isNull()).select(F.explode("keywords").alias("most_searched")).distinct()


def unanswered(programs: DataFrame, ledger: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Distinct non-NULL keywords that neither the ledger nor a stored mapping has an answer for."""
    left = programs.select("most_searched").dropna().distinct().join(answered(ledger), "most_searched", "left_anti")
    return left if mapping is None else left.join(mapping.select("most_searched"), "most_searched", "left_anti")


def ask(programs: DataFrame, path: str, labeller: Labeller | None = None, mapping: DataFrame | None = None,
        batch_size: int = LABEL_BATCH_SIZE, parallelism: int | None = None, waves: int = WAVES) -> str:
    """Ask for what is unanswered and append the calls to the ledger; returns the run's id. Keywords are dealt
    to waves and tasks by hash, so a retried task gets the same ones."""
    spark, run = programs.sparkSession, uuid.uuid4().hex
    tasks = parallelism or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for wave in range(waves):
        own = F.pmod(F.xxhash64(F.lit("wave"), "most_searched"), F.lit(waves)) == wave
        # read anew each time: the waves before are in the ledger by now
        todo = unanswered(programs.filter(own), read_ledger(spark, path), mapping)
        calls = label_requests(todo.repartition(tasks, "most_searched"), labeller, batch_size)
        calls.select("keywords", "reply", "error", F.lit(run).alias("run_id"),
                     F.current_timestamp().alias("called_at")).write.mode("append").parquet(path)
    return run


def genres(programs: DataFrame, ledger: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """``most_searched, Genre`` of the distinct keywords: the stored mapping's genre, else that of
    the last call that was answered, else ``Other``."""
    replies = ledger.filter(F.col("error").isNull())
    # a reply is parsed once and stays where its call is: a keyword travels with its own genre alone. It
    # stands in one answered call, or in several if two runs overlapped
    found = parse_label_replies(replies, "called_at", "run_id").groupBy("most_searched").agg(
        F.max_by(F.struct("Genre"), F.struct("called_at", "run_id"))["Genre"].alias("Genre"))
    wanted = programs.select("most_searched").dropna().distinct()
    if mapping is None:
        return wanted.join(found, "most_searched", "left").select(
            "most_searched", F.coalesce("Genre", F.lit(DEFAULT_GENRE)).alias("Genre"))
    stored = mapping.select("most_searched", F.col("Genre").alias("stored"), F.lit(True).alias("listed"))
    return wanted.join(found, "most_searched", "left").join(stored, "most_searched", "left").select(
        "most_searched", F.when(F.col("listed"), F.col("stored"))
        .otherwise(F.coalesce("Genre", F.lit(DEFAULT_GENRE))).alias("Genre"))


def check_run(ledger: DataFrame, run: str, max_failed_share: float) -> None:
    """Raise if more than the stated share of a run's calls failed (they stay in the ledger)."""
    calls, failed, error = ledger.filter(F.col("run_id") == run).agg(F.count("*"), F.count("error"), F.min("error")).first()
    if failed > max_failed_share * calls:
        raise LabellingFailed(f"{failed} of {calls} labeller calls failed, e.g. {error}")


def times_asked(ledger: DataFrame) -> DataFrame:
    """``most_searched, asked, failed``: calls that each keyword was in, and those of them that failed."""
    return ledger.select(F.explode("keywords").alias("most_searched"), "error").groupBy("most_searched").agg(
        F.count(F.lit(1)).alias("asked"), F.count("error").alias("failed"))

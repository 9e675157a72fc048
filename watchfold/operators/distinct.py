"""Distinct counts that can be merged: dense ids and Spark's bitmap aggregates.

``COUNT(DISTINCT contract)`` of a month cannot be added to that of another month. Here
each key has a dense number in its dimension, and the keys that carry a label in a
month are kept as bitmaps (32,768 keys a bucket, one bit a key). Bitmaps of any months,
labels or loads merge by OR and count exactly, repeated keys or not, so questions over
several months are answered from the stored bitmaps without reading a fact again.

The fact's rows are sent once, by (month, bucket); bitmaps are built where their bucket's rows are, so no
task holds more than its own buckets' and a hot label or month is spread over its buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold.functions.columns import active_days_bin, month_index
from watchfold.functions.constants import PROGRAM_TYPES
from watchfold.operators.behavior import UNCHANGED
from watchfold.operators.bridge import global_positions
from watchfold.session import ensure_checkpoint_dir

MONTH = "month_yyyymm"
BITMAP_SCHEMA = "measure string, month_yyyymm string, label string, bucket bigint, bitmap binary"


# --- dimensions with dense numbers -------------------------------------------------

def numbered_dimension(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """``key, id``: the distinct non-NULL keys, numbered from 1 without gaps, in key order.

    With ``known`` (an earlier result) its numbers stay and only new keys are added behind
    them, so bitmaps stored before keep their meaning.
    """
    ensure_checkpoint_dir(keys.sparkSession)
    distinct = keys.select(F.col(key).cast("string").alias(key)).dropna().distinct()
    start = 0
    if known is not None:
        distinct = distinct.join(known, key, "left_anti")
        start = known.agg(F.max("id")).first()[0] or 0
    new = global_positions(distinct, [key]).select(key, (F.col("pos") + start + 1).alias("id"))
    return new if known is None else known.select(key, "id").unionByName(new)


# --- building ----------------------------------------------------------------------

def key_bitmaps(fact: DataFrame, dimension: DataFrame, key: str, measures: dict[str, Column]) -> DataFrame:
    """Bitmaps of the keys by month, measure and label.

    ``measures`` maps a name to a label expression over the fact; a row with a NULL label does not
    count. Rows with a key that the dimension lacks (NULL) do not count either.
    """
    id_key = F.col("_dimension_key")
    numbered = dimension.select(F.col([c for c in dimension.columns if c != "id"][0]).alias("_dimension_key"), "id")
    labels = F.array(*[F.struct(F.lit(name).alias("measure"), label.cast("string").alias("label"))
                       for name, label in measures.items()])
    rows = (fact.select(MONTH, F.col(key).cast("string").alias("_key"),
                        F.filter(labels, lambda x: x["label"].isNotNull()).alias("labels"))
            .join(numbered, F.col("_key") == id_key)
            .select(MONTH, "labels", F.bitmap_bucket_number("id").alias("bucket"),
                    F.bitmap_bit_position("id").alias("position")))
    return (rows.repartition(MONTH, "bucket")
            .select(MONTH, "bucket", "position", F.inline("labels"))
            .groupBy("measure", MONTH, "label", "bucket").agg(F.bitmap_construct_agg("position").alias("bitmap"))
            .select("measure", MONTH, "label", "bucket", "bitmap"))


def interaction_measures() -> dict[str, Column]:
    """All contracts, their active-days bin, their taste, and the programs they watch."""
    watched = {f"program {p}": F.when(F.col(p) > 0, F.lit(p)) for p in PROGRAM_TYPES}
    return {"all": F.lit("all"), "active_days_bin": active_days_bin("Active_Days"),
            "customer_taste": F.col("customer_taste")} | watched


def behavior_measures() -> dict[str, Column]:
    """All users, those whose genre changed, and those by previous genre."""
    changed = F.col("Trending_Type") != UNCHANGED
    return {"all": F.lit("all"), "changed": F.when(changed, F.lit("changed")),
            "changed_from": F.when(changed, F.col("Previous_Genre"))}


# --- merging and counting ------------------------------------------------------------

def merge(*parts: DataFrame) -> DataFrame:
    """Bitmaps of several loads as one: keys of either are in the result."""
    every = reduce(lambda a, b: a.unionByName(b), parts)
    return every.groupBy("measure", MONTH, "label", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap")) \
        .select("measure", MONTH, "label", "bucket", "bitmap")


def counts(bitmaps: DataFrame, measure: str, *by: str) -> DataFrame:
    """Distinct keys of a measure by any of ``month_yyyymm`` and ``label``, as ``keys``; what is left
    out of ``by`` is merged, so ``counts(b, m, "label")`` counts over all months in ``bitmaps``."""
    merged = bitmaps.filter(F.col("measure") == measure).groupBy(*by, "bucket") \
        .agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias("keys"))


def active_days_distribution(bitmaps: DataFrame) -> DataFrame:
    return counts(bitmaps, "active_days_bin", MONTH, "label").select(
        MONTH, F.col("label").alias("active_days_bin"), F.col("keys").alias("distinct_contract_count"))


def taste_distribution(bitmaps: DataFrame) -> DataFrame:
    return counts(bitmaps, "customer_taste", MONTH, "label").select(
        MONTH, F.col("label").alias("customer_taste"), F.col("keys").alias("distinct_contract_count"))


def program_reach(bitmaps: DataFrame) -> DataFrame:
    """Contracts that watched each program in any of the months, one row a program."""
    names = {f"program {p}": p for p in PROGRAM_TYPES}
    own = bitmaps.filter(F.col("measure").isin(*names)).groupBy("label", "bucket") \
        .agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return own.groupBy("label").agg(F.sum(F.bitmap_count("bitmap")).alias("contracts")) \
        .select(F.col("label").alias("program_name"), "contracts")


def taste_reach(bitmaps: DataFrame) -> DataFrame:
    """Contracts that had each taste in any of the months."""
    return counts(bitmaps, "customer_taste", "label").select(F.col("label").alias("customer_taste"),
                                                             F.col("keys").alias("contracts"))


def genre_change_percent(bitmaps: DataFrame) -> DataFrame:
    """Share of users whose genre changed, in percent with two decimals."""
    both = counts(bitmaps, "all", MONTH).withColumnRenamed("keys", "users").join(
        counts(bitmaps, "changed", MONTH).withColumnRenamed("keys", "changed"), MONTH, "left")
    share = F.lit(100).cast("decimal(4,1)") * F.coalesce("changed", F.lit(0)) / F.col("users")
    return both.select(MONTH, F.round(share, 2).cast("double").alias("percent_changed"))


def retention(bitmaps: DataFrame) -> DataFrame:
    """Per month with a month before it: keys of both, new ones and lost ones.

    Each bucket is sent as its month's and as the one before the next month's; the number in both
    follows from the two counts and that of their union.
    """
    month = month_index(MONTH)
    sent = bitmaps.filter("measure = 'all'").select("bucket", "bitmap", MONTH, F.inline(F.array(
        F.struct(month.alias("slot"), F.lit(True).alias("now")), F.struct((month + 1).alias("slot"), F.lit(False).alias("now")))))
    met = sent.groupBy("slot", "bucket").agg(
        F.max(F.when(F.col("now"), F.col(MONTH))).alias(MONTH), F.max(F.when(~F.col("now"), F.lit(True))).alias("earlier"),
        F.coalesce(F.sum(F.when(F.col("now"), F.bitmap_count("bitmap"))), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.when(~F.col("now"), F.bitmap_count("bitmap"))), F.lit(0)).alias("b"),
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("either"))
    total = met.groupBy("slot").agg(F.max(MONTH).alias(MONTH), F.max("earlier").alias("earlier"),
                                    F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("either").alias("either"))
    return total.filter(F.col(MONTH).isNotNull() & F.col("earlier")).select(
        MONTH, (F.col("a") + F.col("b") - F.col("either")).alias("retained"),
        (F.col("either") - F.col("b")).alias("gained"), (F.col("either") - F.col("a")).alias("lost"))

"""Keyword -> genre labelling as a distributed job with a pluggable labeller.

Stages:

1. :func:`label_requests` deals the distinct keywords out to tasks; each task makes
   one labeller call per batch of at most 150 (``mapInPandas``). A labeller is any
   ``callable(list[str]) -> str`` returning one reply text, e.g. a client for a
   hosted model; the default is the offline rule labeller below. A failed call is
   kept with its error.
2. The replies are checkpointed: a model's replies are costly and need not repeat,
   so a lost executor must not ask again.
3. :func:`parse_label_replies` reads each reply's JSON object with Python's parser
   (``from_json`` accepts trailing text, a second object and single quotes, where
   the labelling contract rejects the batch) and looks the keywords up in Spark.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from itertools import batched

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchfold.functions.constants import (
    DEFAULT_GENRE,
    GENRE_EXAMPLES,
    GENRE_RULES,
    GENRES,
    LABEL_BATCH_SIZE,
)
from watchfold.session import ensure_checkpoint_dir

Labeller = Callable[[list], str]

REPLY_SCHEMA = "keywords array<string>, reply string, error string"


# --- per-row helpers (small, pure Python) ------------------------------------

def rule_label(keyword: str) -> str:
    """The rule genre of one keyword; mirrors :func:`watchfold.functions.rule_genre`."""
    if keyword in GENRE_EXAMPLES:
        return GENRE_EXAMPLES[keyword]
    lowered = keyword.lower()
    for words, genre in GENRE_RULES:
        if any(w.lower() in lowered for w in words):
            return genre
    return DEFAULT_GENRE


def rule_labeller(keywords: list) -> str:
    """Offline labeller: answers like a chat model would, one JSON object wrapped in prose."""
    if not keywords:
        return "{}"
    labels = {k: rule_label(k) for k in keywords}
    return "Here are the genres:\n" + json.dumps(labels, ensure_ascii=False) + "\nDone."


def reply_object(reply: str | None) -> dict[str, str | None] | None:
    """The JSON object between a reply's first ``{`` and last ``}``, its values as text
    (``null`` stays None), or None when there is no such object."""
    _, opening, rest = (reply or "").partition("{")
    body, closing, _ = rest.rpartition("}")
    if not (opening and closing):
        return None
    try:
        found = json.loads("{" + body + "}")
    except ValueError:
        return None
    return {key: v if v is None or isinstance(v, str) else str(v) for key, v in found.items()}


# --- Spark stages --------------------------------------------------------------

def label_requests(programs: DataFrame, labeller: Labeller | None = None,
                   batch_size: int = LABEL_BATCH_SIZE, column: str = "most_searched") -> DataFrame:
    """One row per labeller call: ``keywords`` (at most ``batch_size``), the ``reply`` text and,
    for a call that failed, NULL and the ``error``. Batches run on across Arrow chunks."""
    call = labeller or rule_labeller

    def ask(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keywords = (str(k) for frame in frames for k in frame[column].dropna())
        for batch in map(list, batched(keywords, batch_size)):
            reply, error = None, None
            try:
                reply = call(batch)
            except Exception as e:  # the service is foreign code: any failure is the batch's
                error = f"{type(e).__name__}: {e}"
            yield pd.DataFrame({"keywords": [batch], "reply": [reply], "error": [error]})

    return programs.select(column).mapInPandas(ask, REPLY_SCHEMA)


def parse_label_replies(replies: DataFrame, *keep: str) -> DataFrame:
    """``most_searched, Genre`` for every keyword of every reply row, and the columns to ``keep`` of
    that row: each reply becomes one map (or NULL), the lookup is Spark's."""
    rows = replies.select("keywords", "reply", *keep)

    def objects(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [reply_object(reply) for reply in batch.column("reply").to_pylist()]
            genres = pa.array([None if f is None else list(f.items()) for f in found], pa.map_(pa.string(), pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("keywords", *keep)), genres],
                                             ["keywords", *keep, "genres"])

    schema = T.StructType([*rows.drop("reply").schema, T.StructField("genres", T.MapType(T.StringType(), T.StringType()))])
    one = rows.mapInArrow(objects, schema).select(F.explode("keywords").alias("most_searched"), "genres", *keep)
    answered = F.coalesce(F.map_contains_key("genres", F.col("most_searched")), F.lit(False))
    return one.select("most_searched", F.when(answered, F.col("genres")[F.col("most_searched")])
                      .otherwise(DEFAULT_GENRE).alias("Genre"), *keep)


class LabellingFailed(RuntimeError):
    """Too many labeller calls failed."""


def check_failures(replies: DataFrame, max_failed_share: float) -> None:
    """Raise if more than the stated share of calls failed."""
    calls, failed, error = replies.agg(F.count("*"), F.count("error"), F.min("error")).first()
    if failed > max_failed_share * calls:
        raise LabellingFailed(f"{failed} of {calls} labeller calls failed, e.g. {error}")


def label_genres(programs: DataFrame, labeller: Labeller | None = None,
                 batch_size: int = LABEL_BATCH_SIZE, checkpoint: bool = True,
                 parallelism: int | None = None, max_failed_share: float | None = None) -> DataFrame:
    """Label distinct keywords: ask (in batches), keep the replies, parse them.

    Returns ``most_searched, Genre`` with one row per distinct keyword; a
    keyword the labeller skipped, or whose call failed, gets ``Other``; with
    ``max_failed_share`` a larger share of failed calls is an error instead.
    ``parallelism`` is how many tasks call the labeller at once (the session's
    shuffle partitions by default). The keywords are dealt out explicitly by
    hash, so adaptive execution does not merge the calls into a few tasks, and a
    retried task gets the same keywords.
    """
    spark = programs.sparkSession
    tasks = parallelism or int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = programs.select("most_searched").filter(F.col("most_searched").isNotNull()).distinct()
    replies = label_requests(distinct.repartition(tasks, "most_searched"), labeller, batch_size)
    if checkpoint:
        ensure_checkpoint_dir(spark)
        replies = replies.checkpoint(eager=True)
    if max_failed_share is not None:
        check_failures(replies, max_failed_share)
    return parse_label_replies(replies)


def check_genre_domain(mapping: DataFrame) -> DataFrame:
    """Rows of a keyword -> genre mapping and how many carry a genre outside the closed list."""
    outside = F.col("Genre").isNull() | ~F.col("Genre").isin(*GENRES)
    return mapping.agg(F.count(F.lit(1)).alias("mapping_rows"),
                       F.count(F.when(outside, F.lit(1))).alias("out_of_domain_rows"))

"""Corpus pipeline: language ID, n-gram join, suffix dedup, decontamination, BPE.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame`` and works on all rows its
predecessor kept. All but the last return the columns of ``documents``; the last
returns doc_id, n_tokens and the digests of the ids and of the decoded text.

* language_id drops documents whose language is not recognised (no letter, or a
  score under 0.5).
* ngram_join keeps one document, the one with the smallest id, of each group of
  near duplicates (five words, Jaccard 0.8).
* suffix_dedup cuts every 100-byte repeat but the first out of the texts and drops
  documents of which nothing is left.
* decontamination drops documents that hold a benchmark item.
* bpe encodes and decodes what is left.

Defined cases: null, empty and letterless texts go in the first stage; texts of any length are
read whole; null metadata and a null doc_id are kept; of repeated rows, and of near duplicates
whatever their order, one row of the smallest doc_id stays; ties of languages go to the first by
name; tables without rows give no rows; other columns of ``documents`` are carried to the last
stage under their names and are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchfold.llm import bpe, decontamination, language_id, ngram_join, suffix_dedup
from watchfold.llm.common import read_table
from watchfold.session import scratch_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.first_of_each(docs)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = bpe.round_trip(docs, bpe.vocabulary_file(), digests=True)
    return out.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"),
                      F.col("decoded").alias("decoded_sha256"))


STAGES = [("language_id", language_stage), ("ngram_join", near_duplicate_stage),
          ("suffix_dedup", repeat_stage), ("decontamination", benchmark_stage), ("bpe", encoding_stage)]

# Trained, iterative and byte-level stages: SQL cannot express them; the tests hold
# the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each but the last returns is written as Parquet in the shared folder."""
    docs, base = read_table(spark, sf_dir, "documents"), scratch_path(spark, "pipeline", uuid.uuid4().hex)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{base}/{k}-{name}")
            docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs

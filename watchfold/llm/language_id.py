"""Language ID: multinomial naive Bayes over hashed character n-grams.

The model is one matrix of log probabilities (hash bucket x language). It is
fitted on a bounded sample of labelled rows, at most ``docs_per_language`` for
each language, picked by a hash of ``doc_id``, and sent to every task; its size
is ``buckets * languages`` numbers. Scoring is a map over whole texts without a
shuffle: the n-grams of a few megabytes of text at a time are hashed with numpy
and their rows of the matrix are summed per document.

Defined cases: a null text or one without a letter gets ``und`` and score 0;
without any labelled row every document gets ``und``; a table without rows gives
no rows; repeated rows are predicted each; ties go to the first language by
name. Other columns of the input are neither read nor returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from watchfold.llm.common import doc_groups, read_table, text_buffer

UNKNOWN = "und"
BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
DOCS_PER_LANGUAGE = 3_000        # bound of the labelled sample the model is fitted on
SMOOTHING = 0.5
HELD_OUT_FOLDS = 5
MIN_SCORE = 0.5                  # of a document that ``accepted`` keeps


def letter_table() -> np.ndarray:
    """For each character: itself if a letter, else a space."""
    table = np.arange(0x110000, dtype=np.uint32)
    table[[i for i in range(0x110000) if not chr(i).isalpha()]] = 32
    return table


class GramHasher:
    """Bucket of every character n-gram of a group of texts."""

    def __init__(self, buckets: int, orders: tuple[int, ...]):
        self.buckets, self.orders, self.letters = buckets, orders, letter_table()

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lower-cased letters (others as a space) and the bounds of each text."""
        lowered = [t.lower() for t in texts]
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in lowered], out=bounds[1:])
        codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.letters[codes], bounds

    def grams(self, codes: np.ndarray, bounds: np.ndarray):
        """For each order: (buckets of the grams, bounds of each text's grams)."""
        lengths = np.diff(bounds)
        h = np.zeros(len(codes), np.uint32)
        for order in range(1, max(self.orders) + 1):
            if len(codes) < order:
                return
            h = h[:len(codes) - order + 1] * np.uint32(0x01000193) + codes[order - 1:]
            if order not in self.orders:
                continue
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(order * 0x9E37)
            index = (mixed >> np.uint32(7)) % np.uint32(self.buckets)
            if order == 1:
                yield index, bounds
                continue
            whole = np.ones(len(codes), bool)      # a gram starts here and ends in the same text
            for back in range(1, order):
                ends = bounds[1:] - back
                whole[ends[lengths >= back]] = False
            counts = np.maximum(lengths - order + 1, 0)
            kept = np.zeros(len(bounds), np.int64)
            np.cumsum(counts, out=kept[1:])
            yield index[whole[:len(index)]], kept


def sum_rows(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the rows of ``values`` between consecutive bounds (0 where empty)."""
    out = np.zeros((len(bounds) - 1, values.shape[1]))
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full], axis=0, dtype=np.float64)
    return out


def in_fold(column, folds: int = HELD_OUT_FOLDS):
    """True for the held-out rows: crc32 of the id as text is divisible by ``folds``."""
    return F.crc32(column.cast("string")) % folds == 0


def fit(docs: DataFrame, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS,
        docs_per_language: int = DOCS_PER_LANGUAGE, smoothing: float = SMOOTHING):
    """(languages, log probabilities, log priors) of the rows with a text and a language."""
    rows = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((buckets, 0), np.float32), np.zeros(0)
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, min(1.0, docs_per_language / sizes[lang])).otherwise(share)
    position = F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1_000_000)) / 1e6
    sample = rows.filter(position < share).select("text", "lang")
    index = {lang: i for i, lang in enumerate(languages)}

    def count(batches):
        hasher = GramHasher(buckets, orders)
        totals = np.zeros((len(index), buckets), np.int64)
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            _, offsets = text_buffer(batch.column(0))
            for lo, hi in doc_groups(offsets):
                codes, bounds = hasher.codes(texts[lo:hi])
                owner = np.array([index[x] for x in langs[lo:hi]])
                for grams, kept in hasher.grams(codes, bounds):
                    key = np.repeat(owner, np.diff(kept)) * buckets + grams
                    totals += np.bincount(key, minlength=totals.size).reshape(totals.shape)
        which, bucket = np.nonzero(totals)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(which, pa.int32()),
                                          "bucket": pa.array(bucket, pa.int32()),
                                          "n": pa.array(totals[which, bucket], pa.int64())})

    counted = (sample.mapInArrow(count, "lang int, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((buckets, len(languages)))
    counts[counted.bucket, counted.lang] = counted.n
    counts += smoothing
    log_p = np.log(counts / counts.sum(0)).astype(np.float32)
    total = sum(sizes.values())
    return languages, log_p, np.log([sizes[x] / total for x in languages])


def annotate(docs: DataFrame, model, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """The rows of ``docs`` (text and any other columns) with lang_pred and score. The score is
    the posterior with the evidence of n grams weighed as that of sqrt(n) independent ones."""
    languages, log_p, prior = model
    shared = docs.sparkSession.sparkContext.broadcast((languages, log_p, prior))

    def score(batches):
        names, matrix, priors = shared.value
        hasher = GramHasher(matrix.shape[0], orders)
        for batch in batches:
            column = batch.column("text")
            texts = [t or "" for t in column.to_pylist()]
            _, offsets = text_buffer(column)
            best, score = [], []
            for lo, hi in doc_groups(offsets):
                codes, bounds = hasher.codes(texts[lo:hi])
                lettered = sum_rows((codes != 32)[:, None], bounds)[:, 0] > 0
                if not names:
                    lettered[:] = False
                total, n = np.zeros((hi - lo, max(1, len(names)))), np.zeros(hi - lo)
                for grams, kept in hasher.grams(codes, bounds) if names else ():
                    total += sum_rows(matrix[grams], kept)
                    n += np.diff(kept)
                if names:
                    total = total / np.sqrt(np.maximum(n, 1))[:, None] + priors
                p = np.exp(total - total.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                best += [names[k] if ok else UNKNOWN for k, ok in zip(p.argmax(1), lettered)]
                score += list(np.where(lettered, p.max(1), 0.0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(score, schema)


def predict(docs: DataFrame, model, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    return annotate(docs.select("doc_id", "text"), model, orders).drop("text")


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the rows outside the held-out fold, predict every row."""
    model = fit(docs.filter(~in_fold(F.col("doc_id"))))
    return predict(docs, model)


def accepted(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose language is recognised: not ``und`` and at least ``min_score``."""
    model = fit(docs.filter(~in_fold(F.col("doc_id"))))
    named = docs.toDF(*[f"c{i}" if c != "text" else c for i, c in enumerate(docs.columns)])
    kept = annotate(named, model).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.drop("lang_pred", "score").toDF(*docs.columns)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", in_fold(F.col("doc_id")).alias("held_out"),
                                 "lang_pred", "score")


QUERIES = {"op8_language_id": op8_language_id}

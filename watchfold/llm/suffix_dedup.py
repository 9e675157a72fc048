"""Byte-level dedup of long repeats by a distributed suffix sort on a difference cover.

A difference cover is a sample of positions such that any two equal strings have a
sampled position at the same offset; sorting the sampled suffixes then settles the
rest. A cover of fixed residues would send two thirds (or, for larger periods, a
fifth) of all byte positions through several sorts, many times the corpus. Here the
sample is chosen by content (the least 24-byte hash among a window's positions,
one position in forty), which has the same property for strings of ``width`` bytes.

1. Sampled positions whose whole surroundings repeat, or do not repeat at all, are
   settled by :mod:`watchfold.llm.repeats`; the others meet by their sample.
2. There the suffixes that start at the sampled positions are sorted: triples of bytes
   get names in order, triples of names get names, until a name spans the suffix.
   The same is done with the reversed texts before the samples.
3. The remaining suffixes, those that start ``k`` bytes before a sample, are merged in
   as pairs of the ``k`` bytes and the sampled suffix: two agree on ``width`` bytes if
   the sorted neighbours between them share ``k`` bytes to the left and ``width - k``
   to the right of the sample. This is read off the adjacent common prefixes.

All of it compares bytes, not hashes. (Around a sample with more than
``repeats.OPEN_HOT`` different surroundings, windows are dealt out one by one by a
64-bit hash instead, so that no task gets them all.)

Defined cases: a null text is empty; a text shorter than ``width`` is kept; a null
``doc_id`` counts as the smallest; repeated rows of one ``doc_id`` are one document
and come back each; a table without rows gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchfold.llm.common import byte_table, read_table, run_starts
from watchfold.llm.repeats import Windows, covered, keyed, repeated_windows, unkeyed

WIDTH = 100
GRAM = 24
RESULT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, "
          "removed_starts array<int>, removed_ends array<int>")


def byte_elements():
    table = byte_table(23)

    def elements(data, offsets):
        return table[data], offsets

    return elements


def byte_windows(width: int = WIDTH) -> Windows:
    return Windows(width, min(GRAM, width), 0, byte_elements, None, repeated_suffixes)


def name_triples(rows: np.ndarray) -> np.ndarray:
    """Names, in lexicographic order, of the triples of each row's numbers (padded with 0)."""
    pad = -rows.shape[1] % 3
    if pad:
        rows = np.concatenate([rows, np.zeros((len(rows), pad), rows.dtype)], axis=1)
    bits = int(rows.max(initial=0)).bit_length()
    if 3 * bits > 63:                          # rank the numbers first, then the pairs
        a, b, c = (np.unique(rows[:, k::3], return_inverse=True)[1].reshape(len(rows), -1) for k in range(3))
        pairs = np.unique(a * (b.max(initial=0) + 1) + b, return_inverse=True)[1].reshape(a.shape)
        triples = pairs * (c.max(initial=0) + 1) + c
        return np.unique(triples, return_inverse=True)[1].reshape(triples.shape) + 1
    a, b, c = (rows[:, k::3].astype(np.int64) for k in range(3))
    triples = (a << (2 * bits)) | (b << bits) | c
    return np.unique(triples, return_inverse=True)[1].reshape(triples.shape) + 1


def sort_suffixes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows, common prefix of each with the row before it in that order)."""
    names = rows.astype(np.int64) + 1
    while names.shape[1] > 1:
        names = name_triples(names)
    order = np.argsort(names[:, 0], kind="stable")
    common = np.zeros(len(rows), np.int64)
    for lo in range(1, len(rows), 20_000):
        part = slice(lo, min(lo + 20_000, len(rows)))
        differs = rows[order[part]] != rows[order[lo - 1:part.stop - 1]]
        common[part] = np.where(differs.any(1), differs.argmax(1), rows.shape[1])
    return order, common


def repeated_suffixes(doc, lo, n, at, context, width) -> np.ndarray:
    """For runs with their bytes: which of their windows also start earlier. ``at`` is the
    sample's place in a run's first window; window ``k`` of it starts ``at - k`` before."""
    size = n.astype(np.int64) + width - 1
    start = np.cumsum(size) - size
    at = at.astype(np.int64)
    reach = int(at.max()) if len(at) else 0
    right = np.arange(width)
    ahead = np.where(right < (size - at)[:, None], context[np.minimum((start + at)[:, None] + right, len(context) - 1)], 0)
    left = np.arange(1, reach + 1)
    behind = np.where(left <= at[:, None], context[np.maximum((start + at)[:, None] - left, 0)], 0)
    order_r, common_r = sort_suffixes(ahead)
    order_l, common_l = sort_suffixes(behind) if reach else (np.arange(len(doc)), np.zeros(len(doc), np.int64))
    flags = np.zeros(int(n.sum()), bool)
    first = np.cumsum(n) - n                    # of each run's windows
    by_place = np.lexsort((lo, doc))
    names_r, names_l = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
    for k in range(reach + 1):                  # windows that start k bytes before their sample
        names_r[order_r] = np.cumsum(common_r < width - k)
        names_l[order_l] = np.cumsum(common_l < k) if k else 0
        here = by_place[(at[by_place] >= k) & (at[by_place] - k < n[by_place])]
        key = names_l[here] * (len(doc) + 1) + names_r[here]
        order = np.argsort(key, kind="stable")  # runs of one name, by document and place
        runs = here[order]
        new = run_starts(key[order])
        head = runs[np.maximum.accumulate(np.where(new, np.arange(len(runs)), 0))]
        later = (doc[runs] != doc[head]) | (lo[runs] + at[runs] != lo[head] + at[head])
        flags[first[runs] + at[runs] - k] = later
    return flags


def dedup(docs: DataFrame, width: int = WIDTH, with_text: bool = True) -> DataFrame:
    """Bytes covered by a string of ``width`` bytes that also starts earlier are removed.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, the kept bytes (null
    unless ``with_text``) and the removed runs as byte positions.
    """
    spec = byte_windows(width)

    def finish(ids, texts, cover):
        out = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept",
                               "removed_starts", "removed_ends")}
        for k, text in enumerate(texts):
            data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
            gone = cover(k, len(data))
            edge = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
            starts = np.flatnonzero(edge == 1).astype(np.int32)
            kept = data[~gone].tobytes()
            out["doc_id"].append(ids[k])
            out["n_bytes"].append(len(data))
            out["n_removed"].append(len(data) - len(kept))
            out["n_spans"].append(len(starts))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept if with_text else None)
            out["removed_starts"].append(starts)
            out["removed_ends"].append(np.flatnonzero(edge == -1).astype(np.int32))
        kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(),
                 "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept": pa.binary(),
                 "removed_starts": pa.list_(pa.int32()), "removed_ends": pa.list_(pa.int32())}
        return pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()})

    texts, blocks, _ = repeated_windows(keyed(docs), spec)
    return unkeyed(covered(texts, blocks, spec, finish, RESULT))


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` with repeated bytes cut out of their texts (a character that loses
    some of its bytes goes as a whole) and n_chars, if there, counted anew. A text of which
    nothing is left is dropped with its row."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    named = docs.select("doc_id", "text", *[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)])
    spec = byte_windows(width)

    def finish(ids, texts, cover):
        kept, emptied = [], []
        for k, text in enumerate(texts):
            data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
            gone = cover(k, len(data))
            kept.append(data[~gone].tobytes().decode("utf-8", "ignore") if text.is_valid else None)
            emptied.append(bool(gone.any()) and not kept[-1])
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(kept, pa.string()),
                         "emptied": pa.array(emptied, pa.bool_())})

    texts, blocks, _ = repeated_windows(keyed(named, *[f"c{i}" for i in range(len(rest))]), spec)
    out = unkeyed(covered(texts, blocks, spec, finish, "doc_id long, text string, emptied boolean"))
    out = out.filter("NOT emptied").select(
        "doc_id", "text", *[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)])
    if "n_chars" in rest:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(read_table(spark, sf_dir, "documents"), with_text=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES = {"op5_suffix_dedup": op5_suffix_dedup}

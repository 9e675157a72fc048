"""Substring dedup over words by recompression.

Rounds name runs of equal tokens and then pairs of neighbouring tokens, as in
recompression: in each round a bit of every token's name splits the alphabet, and
a token of the one half followed by one of the other half becomes one symbol. A
name is the hash of what it stands for, so names are the same in every task and a
round needs no exchange. Equal passages get equal symbols inside, whatever
surrounds them. A window of ``width`` words is anchored at the highest symbol that
starts well inside it; windows whose anchors share a symbol meet, and are compared
as described in :mod:`watchfold.llm.repeats`, which makes the result exact.

Near a run of equal tokens a symbol could depend on words outside the window; such
places count as symbols of the lowest level.

Defined cases: a null text has no words; a text shorter than a window is kept; a
null ``doc_id`` counts as the smallest; repeated rows of one ``doc_id`` are one
document and come back each; a table without rows gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from watchfold.llm.common import WordHasher, mix64, read_table, row_bounds
from watchfold.llm.repeats import Windows, covered, keyed, repeated_windows, unkeyed

WIDTH = 20
ROUNDS = 2
BEFORE, AFTER = 5, 6             # words around a symbol's start that decide about its level
RESULT = ("doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, "
          "removed_starts array<int>, removed_ends array<int>")


def symbol_levels(tokens: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """For each position the last round after which a symbol still starts there."""
    n = len(tokens)
    level = np.zeros(n, np.uint64)
    names, starts = tokens, np.arange(n)
    unsure = np.zeros(n, bool)
    for round_ in range(1, rounds + 1):
        head = np.ones(len(names), bool)
        head[1:] = names[1:] != names[:-1]
        at = np.flatnonzero(head)
        length = np.diff(np.append(at, len(names)))
        ends = np.append(starts, n)[at + length]
        runs = length > 1
        cover = np.zeros(n + 1, np.int32)
        np.add.at(cover, starts[at][runs], 1)
        np.add.at(cover, ends[runs], -1)
        in_run = np.cumsum(cover)[:n] > 0
        if round_ == 1:                        # a run of words: nothing near it is sure
            seen = np.concatenate([[0], np.cumsum(in_run)])
            lo = np.maximum(np.arange(n) - BEFORE + 1, 0)
            hi = np.minimum(np.arange(n) + BEFORE - 1, n)
            unsure |= seen[hi] > seen[lo]
        else:                                  # a run of symbols: it and what follows it
            unsure |= in_run
            unsure[1:] |= in_run[:-1]
        names = np.where(runs, mix64(names[at] + length.astype(np.uint64) * np.uint64(0x9E3779B9)), names[at])
        starts = starts[at]
        half = mix64(names + np.uint64(round_ * 0x632BE5AB)) >> np.uint64(63)
        pair = np.zeros(len(names), bool)
        pair[:-1] = (half[:-1] == 0) & (half[1:] == 1)
        second = np.concatenate([[False], pair[:-1]])
        joined = np.append(names[1:], names[:1])
        names = np.where(pair, mix64(names * np.uint64(0xD6E8FEB86659FD93) + joined), names)[~second]
        starts = starts[~second]
        level[starts] = round_
    level[unsure] = 0
    return level


def symbols_first(tokens: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Priority of each position: symbols of a high level first, then by hash."""
    level = symbol_levels(tokens)[:len(grams)]
    return ((np.uint64(ROUNDS) - level) << np.uint64(62)) | (grams >> np.uint64(2))


def word_elements():
    hasher = WordHasher()

    def elements(data, offsets):
        hashes, rows, _, _ = hasher(data, offsets)
        return hashes, row_bounds(rows, len(offsets) - 1)

    return elements


def word_windows(width: int = WIDTH) -> Windows:
    return Windows(width, AFTER, BEFORE, word_elements, symbols_first)


def dedup(docs: DataFrame, width: int = WIDTH, with_text: bool = True) -> DataFrame:
    """Words covered by a window that also starts earlier are removed.

    Returns doc_id, n_words, n_removed, kept_sha256, the kept text (words joined by
    one space; null unless ``with_text``) and the removed runs as word positions.
    """
    spec = word_windows(width)

    def finish(ids, texts, cover):
        out = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept_sha256", "kept",
                               "removed_starts", "removed_ends")}
        for k, text in enumerate(texts):
            words = text.as_buffer().to_pybytes().split() if text.is_valid else []
            gone = cover(k, len(words))
            if gone.any():
                kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
                edge = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
                starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            else:
                kept, starts, ends = words, [], []
            joined = b" ".join(kept)
            out["doc_id"].append(ids[k])
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
            out["kept"].append(joined.decode() if with_text else None)
            out["removed_starts"].append(np.asarray(starts, np.int32))
            out["removed_ends"].append(np.asarray(ends, np.int32))
        kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(),
                 "kept_sha256": pa.string(), "kept": pa.string(),
                 "removed_starts": pa.list_(pa.int32()), "removed_ends": pa.list_(pa.int32())}
        return pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()})

    texts, blocks, _ = repeated_windows(keyed(docs), spec)
    return unkeyed(covered(texts, blocks, spec, finish, RESULT))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(read_table(spark, sf_dir, "documents"), with_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES = {"op1_substring_dedup": op1_substring_dedup}

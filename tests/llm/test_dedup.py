"""Word and byte dedup against brute force, on corpora that force every path."""

import hashlib
import random

import numpy as np
import pytest

from tests.conftest import SF0001
from watchfold.llm import repeats, substring_dedup, suffix_dedup


def brute_force(docs, width, split, join):
    """(length, removed, runs, digest of what is kept) of each document."""
    first, pieces = {}, {d: split(t or "") for d, t in docs}
    key = lambda s: s if isinstance(s, bytes) else tuple(s)
    for d in sorted(pieces, key=lambda d: (d is not None, d)):
        for p in range(len(pieces[d]) - width + 1):
            first.setdefault(key(pieces[d][p:p + width]), (d, p))
    out = {}
    for d, s in pieces.items():
        gone = [False] * len(s)
        for p in range(len(s) - width + 1):
            if first[key(s[p:p + width])] != (d, p):
                gone[p:p + width] = [True] * width
        kept = join([x for x, g in zip(s, gone) if not g])
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(s), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def words(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return {r.doc_id: (r.n_words, r.n_removed, len(r.removed_starts), r.kept_sha256)
            for r in substring_dedup.dedup(frame).collect()}


def text_bytes(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
            for r in suffix_dedup.dedup(frame).collect()}


def corpus(seed, n=160):
    dice = random.Random(seed)
    pool = ["a", "b", "aa", "the", "of", "é"] + [f"w{i}" for i in range(300)]
    text = lambda k, v=pool: " ".join(dice.choice(v) for _ in range(k))
    bases, passage = [text(200) for _ in range(8)], text(60)
    docs = []
    for i in range(n):
        kind = dice.random()
        if kind < 0.15:
            t = text(dice.randint(0, 80), ["a", "b"])
        elif kind < 0.25:
            t = text(dice.randint(0, 200), ["x"])
        elif kind < 0.35:
            t = "é" * dice.randint(0, 300)
        elif kind < 0.65:
            b = dice.choice(bases).split()
            a = dice.randint(0, 150)
            b = b[a:a + dice.randint(5, 150)]
            for _ in range(dice.randint(0, 4)):
                b[dice.randrange(len(b))] = dice.choice(pool)
            t = f"{text(dice.randint(0, 20))} {' '.join(b)}\n{text(dice.randint(0, 20))}"
        elif kind < 0.85:
            t = f"{text(dice.randint(1, 30))} {passage} {text(dice.randint(1, 30))}"
        else:
            t = text(dice.randint(0, 100))
        docs.append((i * 7 % 997, t))
    return docs + [(1500, None), (1501, ""), (1502, " \t\n ")]


@pytest.mark.parametrize("seed,hot_share,open_hot", [(1, 1 / 500, 256), (2, 0.01, 256), (3, 1.0, 2)])
def test_both_equal_brute_force(spark, monkeypatch, seed, hot_share, open_hot):
    """Seed 2: anchors dealt by content; seed 3: windows of open runs dealt singly."""
    monkeypatch.setattr(repeats, "HOT_SHARE", hot_share)
    monkeypatch.setattr(repeats, "OPEN_HOT", open_hot)
    docs = corpus(seed)
    assert words(spark, docs) == brute_force(docs, 20, lambda t: t.encode().split(), b" ".join)
    assert text_bytes(spark, docs) == brute_force(docs, 100, lambda t: t.encode(), bytes)


def test_segments_of_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 1000)
    dice = random.Random(4)
    long = " ".join(f"t{dice.randrange(10_000)}" for _ in range(20_000))
    docs = [(1, long), (2, "new start " + long[5000:9000]), (3, long[:-7])]
    assert text_bytes(spark, docs) == brute_force(docs, 100, lambda t: t.encode(), bytes)
    assert words(spark, docs) == brute_force(docs, 20, lambda t: t.encode().split(), b" ".join)


def test_queries_on_the_small_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    want = brute_force(docs, 20, lambda t: t.encode().split(), b" ".join)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in substring_dedup.op1_substring_dedup(spark, SF0001).collect()}
    assert got == {d: (v[0], v[1], v[3]) for d, v in want.items()}
    want = brute_force(docs, 100, lambda t: t.encode(), bytes)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.op5_suffix_dedup(spark, SF0001).collect()}
    assert got == want


def test_defined_cases(spark):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(5, t, 1, "b"), (None, t, 2, "c"), (9, t, 3, "d"), (9, t, 3, "d"), (7, "short", 4, None), (8, None, 5, "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, bucket int, doc string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup.dedup(frame).collect())
    assert got == [(0, 0), (5, 40), (7, 0), (8, 0), (9, 40), (9, 40)]     # a null id comes first
    kept = suffix_dedup.without_repeats(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.bucket, r.doc) for r in kept.collect()) == [(0, 2, "c"), (7, 4, None), (8, 5, "e")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.dedup(empty).collect() == [] and suffix_dedup.dedup(empty).collect() == []


def test_suffix_order_and_common_prefixes():
    dice = np.random.default_rng(3)
    rows = dice.integers(0, 3, (500, 100)).astype(np.uint8)
    rows[100:200, :60] = rows[0, :60]
    order, common = suffix_dedup.sort_suffixes(rows)
    tuples = [bytes(r) for r in rows]
    assert [tuples[i] for i in order] == sorted(tuples)
    for k in range(1, len(order)):
        a, b = tuples[order[k - 1]], tuples[order[k]]
        assert common[k] == next((i for i in range(100) if a[i] != b[i]), 100)


def test_triples_of_many_names():
    dice = np.random.default_rng(5)
    rows = dice.integers(0, 1 << 40, (300, 6))
    names = suffix_dedup.name_triples(rows)
    flat = [tuple(r) for r in rows.reshape(-1, 3)]
    rank = {t: k + 1 for k, t in enumerate(sorted(set(flat)))}
    assert names.ravel().tolist() == [rank[t] for t in flat]


def test_symbols_depend_on_their_surroundings_only():
    """The level of a symbol's start is the same wherever its surroundings stand."""
    dice = np.random.default_rng(7)
    near = substring_dedup.BEFORE
    for _ in range(200):
        core = dice.integers(0, 4, 14).astype(np.uint64)
        a, b = (np.concatenate([dice.integers(0, 4, 9).astype(np.uint64), core,
                                dice.integers(0, 4, 9).astype(np.uint64)]) for _ in range(2))
        x, y = (substring_dedup.symbol_levels(t)[9 + near:9 + 14 - near] for t in (a, b))
        assert x.tolist() == y.tolist()

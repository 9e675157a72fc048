"""SimHash near-dedup against brute force."""

import random
import re

import numpy as np
import xxhash

from watchfold.llm import simhash


def plain_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """{row number: smallest id} by testing every pair."""
    own = list(range(len(rows)))

    def top(i):
        while own[i] != i:
            i = own[i]
        return i
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if bin(a ^ rows[j][1]).count("1") <= 3:
                own[max(top(i), top(j))] = min(top(i), top(j))
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[top(i)] = min(ids.get(top(i), doc), doc)
    return [ids.get(top(i)) for i in range(len(rows))]


def spark_hash_is_the_same(spark, text):
    from pyspark.sql import functions as F
    row = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t").alias("h")).first()
    return row.h % (1 << 64)


def edges_of(spark, fps, group):
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp bigint").repartition(3)
    return [(r.fp % (1 << 64), r.other % (1 << 64)) for r in simhash.links(df, group).collect()]


def groups(fps, edges):
    own = {f: f for f in fps}

    def top(f):
        while own[f] != f:
            f = own[f]
        return f
    for a, b in edges:
        assert bin(a ^ b).count("1") <= 3
        own[max(top(a), top(b))] = min(top(a), top(b))
    return {f: top(f) for f in fps}


def test_fingerprints_equal_the_plain_ones():
    dice = random.Random(3)
    texts = ["", " \t\n", "One", "one TWO", "a b c", "A B\tC\x0bd", "Ünï Ÿ x y z", "über" * 50]
    texts += [" ".join(dice.choice(["lorem", "Ipsum", "dolor", "中文"]) for _ in range(dice.randint(1, 60)))
              for _ in range(40)]
    for t in texts:
        assert simhash.fingerprint(t.encode()) == plain_fingerprint(t)


def test_hash_is_xxh64_with_seed_42(spark):
    assert spark_hash_is_the_same(spark, "a b c") == xxhash.xxh64_intdigest(b"a b c", 42)


def test_very_long_text_is_counted_in_pieces(monkeypatch):
    text = " ".join(str(i % 977) for i in range(30_000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "HASHES", 1_000)
    assert simhash.fingerprint(text.encode()) == whole


def test_two_halves_of_close_fingerprints_share_a_variant():
    dice = np.random.default_rng(5)
    for _ in range(300):
        a = int(dice.integers(0, 1 << 64, dtype=np.uint64))
        b = a
        for bit in dice.choice(64, dice.integers(0, 4), replace=False):
            b ^= 1 << int(bit)
        path, value = 0, 0
        for level in range(3):               # at each level, within a variant of the one before
            both = [{(int(p), int(v)) for p, v, _ in zip(*simhash.variants(np.array([x], np.uint64), level, path, value))}
                    for x in (a, b)]
            assert len(both[0]) == 2 * simhash.WIDTHS[level]
            shared = both[0] & both[1]
            assert shared
            path, value = sorted(shared)[0]
            low, width = simhash.free_segment(path, level + 1)
            assert width == simhash.WIDTHS[level] and 0 <= low <= 64 - width


def test_forest_connects_what_pairs_connect():
    dice = np.random.default_rng(7)
    base = dice.integers(0, 1 << 64, 6, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:
        f = int(b)
        for _ in range(60):
            f ^= 1 << int(dice.integers(64))
            fps.add(f)
    fps = np.array(sorted(fps), np.uint64)
    found = groups(fps.tolist(), list(zip(*(x.tolist() for x in simhash.forest(fps)))))
    plain = plain_components([(i, int(f)) for i, f in enumerate(fps)])
    assert len(set(found.values())) == len(set(plain))
    assert len({(found[int(f)], p) for f, p in zip(fps, plain)}) == len(set(plain))


def test_links_with_and_without_deeper_levels(spark):
    dice = np.random.default_rng(11)
    centre = int(dice.integers(0, 1 << 64, dtype=np.uint64))
    fps = {centre, 0, 1, 7, 15, (1 << 64) - 1}
    for _ in range(150):                     # one dense group, most of it in common halves
        f = centre
        for bit in dice.choice(64, dice.integers(1, 7), replace=False):
            f ^= 1 << int(bit)
        fps.add(f)
    for _ in range(100):                     # many with one half in common, far apart in the other
        fps.add((centre >> 32 << 32) | int(dice.integers(1 << 32)))
    fps = sorted(fps)
    plain = plain_components([(i, f) for i, f in enumerate(fps)])
    for group in (simhash.GROUP, 8):
        found = groups(fps, edges_of(spark, fps, group))
        assert len({(found[f], p) for f, p in zip(fps, plain)}) == len(set(plain)) == len(set(found.values()))


def test_near_duplicates_and_defined_cases(spark):
    dice = random.Random(13)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(dice.choice(words) for _ in range(dice.randint(1, 250))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts, start=10)]
    for i in range(60):                      # copies with one word changed or put at the end
        w = texts[i].split()
        w[dice.randrange(len(w))] = dice.choice(words)
        rows.append((1_000 + i, " ".join(w)))
    rows += [(5, None), (6, ""), (7, " \n"), (8, texts[0].upper()), (8, texts[0]), (None, texts[0]), (9, "word " * 40_000),
             (4, "x"), (3, "x y")]
    df = spark.createDataFrame([(d, t, t, "z") for d, t in rows], "doc_id bigint, text string, fp string, component_id string")
    out = simhash.near_duplicates(df.repartition(4))
    assert out.columns == ["doc_id", "fp", "component_id"]
    got = sorted(((r.doc_id is None, r.doc_id, r.fp % (1 << 64), r.component_id) for r in out.collect()), key=str)
    fps = [(d, plain_fingerprint(t)) for d, t in rows]
    want = sorted(((d is None, d, f, c) for (d, f), c in zip(fps, plain_components(fps))), key=str)
    assert got == want
    assert {r.component_id for r in out.filter("doc_id IN (5, 6, 7)").collect()} == {5}
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(None, "a b c d")], "doc_id bigint, text string")
    assert simhash.near_duplicates(alone).collect()[0].component_id is None

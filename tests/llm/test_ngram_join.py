import random
import re
from collections import Counter, defaultdict

import pytest

from tests.conftest import SF0001
from watchfold.llm import ngram_join as nj


def sets_of(docs, size=5):
    out = {}
    for doc_id, text in docs:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        shingles = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
        out[doc_id] = frozenset(shingles or ([tuple(words)] if words else []))
    return out


def brute_force(docs):
    """(n_shingles, component_id) of each document, from all pairs that share a shingle."""
    sets, holders, parent = sets_of(docs), defaultdict(list), {}
    for doc_id, s in sets.items():
        parent[doc_id] = doc_id
        for x in s:
            holders[x].append(doc_id)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, s in sets.items():
        for b, shared in Counter(y for x in s for y in holders[x] if y > a).items():
            if 100 * shared >= 80 * (len(s) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def found(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in nj.components(frame).collect()}


def corpus(seed, n=260):
    """Chains of near copies, shared passages, hot groups, short and odd texts."""
    dice = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    text = lambda k: [dice.choice(words) for _ in range(k)]
    bases, passages = [text(dice.randint(6, 150)) for _ in range(12)], [text(30) for _ in range(3)]
    docs = []
    for i in range(n):
        kind = dice.random()
        if kind < 0.5:
            t = list(dice.choice(bases))
            for _ in range(dice.choice([0, 0, 1, 1, 2, 3])):
                t[dice.randrange(len(t))] = dice.choice(words)
        elif kind < 0.8:
            t = text(dice.randint(0, 40)) + dice.choice(passages) + text(dice.randint(0, 40))
        else:
            t = text(dice.choice([0, 1, 3, 4, 5, 6, 80]))
        docs.append((i * 37 % 1009, " ".join(t)))
    return docs


@pytest.mark.parametrize("seed,hot,whole", [(1, 64, 64), (2, 4, 0), (3, 2, 0), (4, 8, 30)])
def test_equals_brute_force(spark, monkeypatch, seed, hot, whole):
    monkeypatch.setattr(nj, "HOT", hot)
    monkeypatch.setattr(nj, "WHOLE", whole)
    monkeypatch.setattr(nj, "TASK_LIST", 3 if seed == 2 else 1_024)         # 2: longer lists are joined
    monkeypatch.setattr(nj, "SAMPLE_COUNT", 10_000 if seed == 3 else 3)     # 3: the sample sees nothing
    docs = corpus(seed)
    assert found(spark, docs) == brute_force(docs)


def test_sets_whose_first_hashes_clash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(nj, "ID_BITS", 6)          # 64 values for far more sets
    docs = corpus(5)
    assert found(spark, docs) == brute_force(docs)


def test_query_on_the_small_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.op4_ngram_join(spark, SF0001).collect()}
    assert got == brute_force(docs)


def test_defined_cases(spark):
    same = "One Two three four five six"
    docs = [(5, same), (3, same.lower()), (7, None), (8, ""), (9, " \t\n"), (1, "a b"), (2, "A  B"),
            (None, "a b"), (3, same.lower()), (4, "é é é é é é")]
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs],
                                  "doc_id long, text string, component_id string, n int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nj.components(frame).collect()),
                 key=lambda r: (r[0] or 0, r[1]))
    assert got == [(None, 1, None), (1, 1, None), (2, 1, None), (3, 2, 3), (3, 2, 3), (4, 1, 4), (5, 2, 3),
                   (7, 0, 7), (8, 0, 8), (9, 0, 9)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert nj.components(empty).collect() == []
    kept = nj.first_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [3, 4, 7, 8, 9]


def test_a_very_long_text(spark):
    long = " ".join(f"t{i}" for i in range(300_000))
    docs = [(1, long), (2, long + " end"), (3, "t1 t2 t3 t4 t5")]
    assert found(spark, docs) == {1: (299_996, 1), 2: (299_997, 1), 3: (1, 3)}


def test_long_lists_are_dealt_without_pairs_of_passive_sets(spark, monkeypatch):
    """Each pair that may meet lies in one group at least; rows grow with the list, not with its square."""
    monkeypatch.setattr(nj, "TASK_LIST", 8)
    monkeypatch.setattr(nj, "GUESTS", 16)
    rows = [(1, k, 0, 10, False, False, 3, k) for k in range(3)]                       # kept for their own level
    rows += [(1, 10 + k, 2, 10, False, False, 1, 10 + k) for k in range(100)]          # kept for lower levels only
    rows += [(2, k, 2, 10, k == 0, k > 0, 3, k) for k in range(60)]                    # guests and a short set
    rows += [(3, k, 2, 10, False, False, 1, k) for k in range(50)]                     # nothing can meet
    rows += [(4, k, 0, 10, False, False, 3, k) for k in range(9)]                      # too many: joined
    rows += [(5, k, 0, 10, False, False, 3, 7) for k in range(5)]                      # one component
    labelled = spark.createDataFrame(rows, "list_id long, set_id long, level long, n long, short boolean, "
                                           "guest boolean, top long, component long")
    dealt, _ = nj.deal_lists(labelled, 1)
    got = dealt.collect()
    assert {r.list_id for r in got if r.long} == {4} and {r.list_id for r in got} == {1, 2, 4}
    groups = {}
    for r in got:
        groups.setdefault((r.list_id, r.home, r.part), []).append(r)
    met = {(lid, min(a.set_id, b.set_id), max(a.set_id, b.set_id)) for (lid, *_), members in groups.items()
           for a in members for b in members if not a.passive and a.set_id != b.set_id}
    want = {(1, a, b) for a in range(3) for b in [*range(a + 1, 3), *range(10, 110)]} | {(2, 0, k) for k in range(1, 60)}
    assert want <= met
    assert sum(r.list_id == 1 for r in got) <= 100 + 3 * 8 and max(len(m) for m in groups.values()) < 60

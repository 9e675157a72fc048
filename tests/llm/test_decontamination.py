import random

import numpy as np
import pytest

from watchfold.llm import decontamination as dc

DICE = random.Random(11)
ALPHABET = "abcdefghijklmnoprstu"


def word():
    return "".join(DICE.choice(ALPHABET) for _ in range(DICE.randint(2, 9)))


VOCABULARY = [word() for _ in range(600)]


def text(n):
    return " ".join(DICE.choice(VOCABULARY) for _ in range(n)).capitalize() + "."


def edited(t, rate):
    out = []
    for c in t:
        u = DICE.random()
        if u < rate / 3:
            continue
        out.append(DICE.choice(ALPHABET) if u < 2 * rate / 3 else c)
        if 2 * rate / 3 <= u < rate:
            out.append(DICE.choice(ALPHABET))
    return "".join(out)


ITEMS = [(i, text(DICE.randint(15, 60))) for i in range(60)]


def distance(a, t):
    """Edit distance of ``a`` to its best substring of ``t``, cell by cell."""
    row = [0] * (len(t) + 1)
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def run(spark, docs, items=ITEMS):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return dc.find(frame, spark.createDataFrame(items, "item_id long, text string")).collect()


def test_best_substring_equals_cell_by_cell():
    dice = random.Random(2)
    for _ in range(300):
        a = bytes(dice.choice(b"abc") for _ in range(dice.randint(1, 15)))
        t = bytes(dice.choice(b"abc") for _ in range(dice.randint(0, 30)))
        assert dc.best_substring(a, t)[0] == distance(a, t)


@pytest.mark.parametrize("rate,recall", [(0.0, 1.0), (0.03, 0.99), (0.08, 0.95)])
def test_recall_and_precision_against_brute_force(spark, rate, recall):
    docs = [(k, text(40) + " " + edited(t, rate) + " " + text(40)) for k, (_, t) in enumerate(ITEMS)]
    docs += [(100 + k, text(200)) for k in range(40)]
    true = {(d, i) for d, t in docs for i, item in ITEMS if (d == i or d >= 100)
            and distance(dc.normal(item.encode()), dc.normal(t.encode())) <= 0.2 * len(dc.normal(item.encode()))}
    got = {(r.doc_id, r.item_id) for r in run(spark, docs)}
    assert len(true & got) >= recall * len(true) and got <= true


@pytest.mark.parametrize("words,rate", [((15, 60), 0.15), ((15, 60), 0.2), ((8, 14), 0.1), ((8, 14), 0.2), ((5, 7), 0.2)])
def test_recall_near_the_greatest_distance(words, rate):
    items = [(i, text(DICE.randint(*words))) for i in range(150)]
    docs = [(text(20) + " " + edited(t, rate) + " " + text(20)).encode() for _, t in items]
    shortest = [dc.best_substring(dc.normal(t.encode()), dc.normal(d))[0] <= int(0.2 * len(dc.normal(t.encode())))
                for (_, t), d in zip(items, docs)]
    data, offsets = np.frombuffer(b"".join(docs), np.uint8), np.cumsum([0] + [len(d) for d in docs])
    got = {(r[0], r[1]) for r in dc.Searcher(dc.Items(items, 0.2)).search(data, offsets)}
    assert sum(shortest) >= 50
    assert sum((k, k) in got for k, near in enumerate(shortest) if near) >= 0.98 * sum(shortest)


def test_items_of_few_words_are_found(spark):
    items = [(1, "Capital of France? Paris!"), (2, "東京は日本の首都で、人口は世界でも最大級の都市である。"), (3, "x=17"),
             (4, "ประเทศไทยมีเมืองหลวงชื่อกรุงเทพมหานคร"), (5, "..."), (6, "Zugspitze")]
    docs = [(10, text(9) + " the capital of france: Paris, " + text(9)), (20, "答えは東京は日本の首都で、人口は世界でも最大級の市である。と"),
            (30, "so X = 17."), (40, "ก " + items[3][1][:10] + "ก" + items[3][1][10:]), (50, "... ?"), (60, "the Zugspitz mountain")]
    got = {(r.doc_id, r.item_id): r for r in run(spark, docs, items)}
    assert set(got) == {(10, 1), (20, 2), (30, 3), (40, 4), (60, 6)}
    assert got[30, 3].distance == 0 and got[60, 6].distance == 1
    part = docs[0][1].encode()[got[10, 1].start_byte:][:got[10, 1].n_bytes]
    assert part == b"capital of france: Paris"


def test_result_columns_and_defined_cases(spark):
    item = ITEMS[0][1]
    docs = [(1, "Début: " + item.upper().replace(" ", "  ")), (2, None), (3, ""), (4, item), (4, item),
            (None, item), (5, text(30))]
    rows = sorted(run(spark, docs, ITEMS[:3] + [(7, None), (8, "two words")]), key=lambda r: r.doc_id or 0)
    assert [(r.doc_id, r.item_id, r.distance) for r in rows] == [(None, 0, 0), (1, 0, 0), (4, 0, 0), (4, 0, 0)]
    exact = [r for r in rows if r.doc_id == 4][0]
    assert exact.start_byte == 0 and item.encode()[:exact.n_bytes].decode() == item[:-1]
    assert run(spark, docs, [(9, "")]) == [] and run(spark, [], ITEMS) == []


def test_clean_keeps_the_other_rows_and_columns(spark):
    item = ITEMS[0][1]
    frame = spark.createDataFrame([(1, "u", "x " + item, 0.5), (2, "v", text(30), None), (3, None, None, 1.0)],
                                  "item_id long, doc_id string, text string, distance double")
    kept = dc.clean(frame, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.schema == frame.schema and sorted(r.item_id for r in kept.collect()) == [2, 3]


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 500)
    docs = [(k, text(10) + " " + t) for k, (_, t) in enumerate(ITEMS[:8])]
    assert len(dc.item_blocks(spark.createDataFrame(ITEMS[:8], "item_id long, text string"))) > 2
    assert {(r.doc_id, r.item_id) for r in run(spark, docs, ITEMS[:8])} == {(k, k) for k in range(8)}


def test_a_very_long_text(spark):
    docs = [(1, text(150_000) + " " + ITEMS[5][1] + " " + text(1000))]
    assert [(r.doc_id, r.item_id) for r in run(spark, docs)] == [(1, 5)]


def test_blocks_hold_every_item_once(spark, monkeypatch):
    rows = [(i, f"item {i} " * (i % 7)) for i in range(200)] + [(3, None), (None, "x"), (5, "item 5 " * 5)]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    monkeypatch.setattr(dc, "BLOCK_BYTES", 1_000)
    blocks = [dc.items_of(b) for b in dc.item_blocks(benchmark)]
    assert len(blocks) > 5 and max(map(len, blocks)) < 60
    assert sorted(map(str, (item for block in blocks for item in block))) == sorted(map(str, set(rows)))
    assert [dc.items_of(b) for b in dc.item_blocks(benchmark.limit(0))] == [[]]


def test_several_blocks_find_what_one_finds(spark, monkeypatch):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(12))) for i in range(30)]
    docs = spark.createDataFrame([(i, f"before {text} after") for i, text in items if i % 3], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, dc.find(docs, benchmark).collect()))
    monkeypatch.setattr(dc, "BLOCK_BYTES", 500)
    assert sorted(map(tuple, dc.find(docs, benchmark).collect())) == one
    assert {(i, i) for i, _ in items if i % 3} <= {(r[0], r[1]) for r in one}
    assert {r.doc_id for r in dc.clean(docs, benchmark).collect()} == set()

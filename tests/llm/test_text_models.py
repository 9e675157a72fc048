"""Language ID, token counts, fingerprints, quality and license scans."""

import hashlib
import random
import textwrap
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF0001, SF001
from watchfold.llm import fingerprints as fp
from watchfold.llm import language_id as li
from watchfold.llm import licenses as lc
from watchfold.llm import quality as q
from watchfold.llm import token_counts as tc


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- language ID -------------------------------------------------------------------

def test_language_of_held_out_documents(spark):
    docs = documents(spark, SF001)
    out = {r.doc_id: r for r in li.op8_language_id(spark, SF001).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert set(out) == set(truth)
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0]
    assert {d for d, r in out.items() if r.held_out} == set(held)
    assert sum(out[d].lang_pred == truth[d] for d in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in out.values())


def test_grams_equal_those_counted_one_by_one():
    hasher = li.GramHasher(1 << 14, (1, 2, 3))
    texts = ["Abc", "", "é", "a1b", "日本語 text", "x" * 40]
    codes, bounds = hasher.codes(texts)
    for order, (grams, kept) in zip((1, 2, 3), hasher.grams(codes, bounds)):
        assert np.diff(kept).tolist() == [max(0, len(t) - order + 1) for t in texts]
        alone = [list(hasher.grams(*hasher.codes([t])))[order - 1][0].tolist() if len(t) >= order else []
                 for t in texts]
        assert grams.tolist() == [g for row in alone for g in row]


def test_language_defined_cases(spark):
    rows = [(i, f"the house is {i} big and old", "en") for i in range(30)]
    rows += [(100 + i, f"das haus ist {i} gross und alt", "de") for i in range(30)]
    rows += [(200, None, "en"), (201, "", "de"), (202, "123 ... !", None), (None, "the old house", None),
             (203, "the old house and the big house", None), (203, "the old house and the big house", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {}
    for r in li.identify(docs).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert got[200] == got[201] == got[202] == [("und", 0.0)]
    assert [x[0] for x in got[203]] == ["en", "en"] and got[None][0][0] == "en"
    assert li.identify(docs.limit(0)).collect() == []
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in li.identify(unlabelled).collect()} == {"und"}
    kept = li.accepted(docs.withColumn("score", F.lit("own")))
    assert kept.columns == ["doc_id", "text", "lang", "score"]
    assert kept.filter("doc_id IN (200, 201, 202)").count() == 0 and kept.filter("doc_id < 30").count() >= 28


def test_emoji_are_no_letters(spark):
    rows = [(i, f"the house is {i} big and old", "en") for i in range(30)]
    rows += [(i, f"das haus {i} ist alt", "de") for i in range(100, 130)]
    rows += [(200, "😀🎉 123 🚀", None), (201, "🄰🅱 \U0001F600", None), (202, "the 😀 house 🎉 is old", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.identify(docs).collect()}
    assert got[200] == got[201] == ("und", 0.0) and got[202][0] == "en"
    assert li.accepted(docs).filter("doc_id IN (200, 201)").count() == 0
    codes, _ = li.GramHasher(1 << 14, (1,)).codes(["a😀𐐨𠀀"])
    assert codes.tolist() == [97, 32, ord("𐐨"), ord("𠀀")]


# --- token counts ------------------------------------------------------------------

def test_token_counts_equal_the_library_unigram(spark):
    tokenizers = pytest.importorskip("tokenizers")
    pieces = tc.load_pieces(tc.vocabulary_file())
    unigram = tokenizers.Tokenizer(tokenizers.models.Unigram([("<unk>", -100.0), *pieces.items()], 0, False))
    docs = {r.doc_id: r.text or "" for r in documents(spark, SF0001).collect()}
    for r in tc.op2_token_counts(spark, SF0001).collect():
        words = docs[r.doc_id].split()
        assert r.n_pre_tokens == len(words)
        assert r.n_tokens == sum(len(unigram.encode(tc.WORD_MARK + w).tokens) for w in words)


def viterbi(word, pieces):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        options = [(best[end - 1][0] + tc.FALLBACK * size, -(best[end - 1][1] + size))]
        options += [(best[a][0] + pieces[word[a:end]], -(best[a][1] + 1)) for a in range(end) if word[a:end] in pieces]
        score, tokens = max(options)
        best.append((score, -tokens))
    return best[-1][1]


def test_shared_prefixes_change_nothing():
    pieces = {"a": -1.0, "b": -1.0, "ab": -2.0, "abc": -3.5, "c": -2.0, "▁": -1.0, "▁a": -1.5}
    dice = random.Random(3)
    words = sorted({"▁" + "".join(dice.choice("abcdé") for _ in range(dice.randint(0, 9))) for _ in range(300)})
    assert tc.PrefixScorer(pieces).counts(words) == [viterbi(w, pieces) for w in words]


def test_token_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "日本 😀"), (4, "日本 😀"), (None, "the"), (5, "x" * 100_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit(7))
    got = sorted((r.doc_id or 0, r.n_pre_tokens) for r in tc.count_tokens(frame, tc.vocabulary_file()).collect())
    assert got == [(0, 1), (1, 0), (2, 0), (3, 0), (4, 2), (4, 2), (5, 1)]
    assert tc.count_tokens(frame.limit(0), tc.vocabulary_file()).collect() == []


# --- fingerprints ------------------------------------------------------------------

def test_fingerprints_of_the_small_tables(spark):
    docs = sorted((r.doc_id, r.text or "") for r in documents(spark, SF0001).collect())
    out = {r.doc_id: r for r in fp.op3_fingerprints(spark, SF0001).collect()}
    same = {}
    for k, (doc_id, t) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        edited = t[:len(t) - len(t) // 4] + following[:len(t) // 4]
        r = out[doc_id]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert same.setdefault(t, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and (r.near_edited > 0.6 or len(t) < 20)
    assert sum(r.near_edited > r.near_next for r in out.values()) >= 0.99 * len(out)


def test_walk_resumes_where_it_stopped():
    e = fp.Embedder()
    dice = random.Random(9)
    for n in (0, 1, 3, 50, 400, 3000):
        t = "".join(dice.choice("abc déf") for _ in range(n))
        edit = "".join(dice.choice("xyz ") for _ in range(n // 4))
        kept = n - n // 4
        own, other = e.both(t, edit, kept)
        assert own == e.both(t, "", n)[0] == e.both(t, "", n)[1]
        assert other == e.both(t[:kept] + edit, "", len(t[:kept] + edit))[0]
        assert e.likeness(own, n, own, n) == 1.0


def test_fingerprint_defined_cases(spark):
    rows = [(3, "abc " * 50), (None, "first"), (7, None), (9, ""), (9, ""), (5, "abc " * 50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("x"))
    got = sorted(fp.fingerprint(frame).collect(), key=lambda r: r.doc_id or 0)
    assert [(r.doc_id, r.n_chars) for r in got] == [(None, 5), (3, 200), (5, 200), (7, 0), (9, 0), (9, 0)]
    assert got[1].near_next == 1.0 and got[2].near_next == 0.0 and got[3].near_next == 1.0
    assert got[3].fingerprint == "0:"
    one = spark.createDataFrame([(1, "only text")], "doc_id long, text string")
    assert fp.fingerprint(one).first().near_next == 1.0
    assert fp.fingerprint(one.limit(0)).collect() == []
    groups = {r.doc_id: r.near_group for r in fp.near_groups(fp.fingerprint(frame)).collect()}
    assert groups[3] == groups[5] == 3 and groups[7] == groups[9] == 7


def test_near_groups_find_edited_copies(spark):
    dice = random.Random(21)
    words = [f"w{i}" for i in range(500)]
    base = [" ".join(dice.choice(words) for _ in range(300)) for _ in range(40)]
    docs = [(k, t) for k, t in enumerate(base)]
    for k, t in enumerate(base):
        w = t.split()
        w[dice.randrange(250, 300)] = "changed"
        docs.append((100 + k, " ".join(w)))
    prints = fp.fingerprint(spark.createDataFrame(docs, "doc_id long, text string"))
    groups = {r.doc_id: r.near_group for r in fp.near_groups(prints).collect()}
    assert sum(groups[100 + k] == k for k in range(40)) >= 36
    assert len({groups[k] for k in range(40)}) == 40


def test_exact_copies_of_short_texts_meet(spark):
    dice = random.Random(4)
    words = ["".join(dice.choice("etaoinshrdlu") for _ in range(dice.randint(2, 8))) for _ in range(400)]
    texts = sorted({" ".join(dice.choice(words) for _ in range(k)) for k in (1, 2, 2, 3) for _ in range(400)})
    docs = [(10_000 * copy + k, t) for copy in (0, 1) for k, t in enumerate(texts)]
    prints = fp.fingerprint(spark.createDataFrame(docs, "doc_id long, text string"))
    groups = {r.doc_id: r.near_group for r in fp.near_groups(prints).collect()}
    assert len(groups) == len(docs) and all(groups[k] == groups[10_000 + k] for k in range(len(texts)))


@pytest.mark.parametrize("group", [fp.GROUP, 7])
def test_pairs_beside_the_hub_are_compared(spark, monkeypatch, group):
    monkeypatch.setattr(fp.Embedder, "bands", lambda self, fingerprint, n_chars: np.array([1]))
    dice = random.Random(8)
    base = [" ".join(dice.choice("abcdefgh") * 4 for _ in range(60)) for _ in range(30)]
    docs = [(2 * k + c, t + " end" * c) for k, t in enumerate(base) for c in (0, 1)]
    prints = fp.fingerprint(spark.createDataFrame(docs, "doc_id long, text string"))
    groups = {r.doc_id: r.near_group for r in fp.near_groups(prints, group=group).collect()}
    assert all(groups[2 * k] == groups[2 * k + 1] for k in range(30))


def plain_walk(text):
    """The fingerprint by walking one step at a time."""
    grid = np.arange(fp.PERIOD * 256, dtype=np.uint64) + np.uint64(1 << 32)
    moves = (fp.mix64(grid) >> np.uint64(63)).astype(bool).reshape(256, fp.PERIOD)
    digits = fp.mix64(np.arange(1 << 16, dtype=np.uint64) + np.uint64(5)) >> np.uint64(60)
    level = max(0, (2 * len(text) // fp.SAMPLES).bit_length() - 1) if text else 0
    symbols = [(ord(c) * 0x9E3779B1 % (1 << 32)) >> 24 for c in text]
    step, out = 0, []
    for c in symbols:
        while True:
            if fp.in_level(np.array([step]), level)[0]:
                out.append(fp.DIGITS[int(digits[c * 256 + (step & 255)])])
            moved = moves[c][step % fp.PERIOD]
            step += 1
            if moved:
                break
    return f"{step:x}:{''.join(out)}"


def test_walk_equals_one_step_at_a_time():
    e, dice = fp.Embedder(), random.Random(17)
    for n in (0, 1, 2, 60, 64, 129, 700, 9000):
        t = "".join(dice.choice("abc déf日😀") for _ in range(n))
        assert e.both(t, "", n)[0] == plain_walk(t)


def test_near_groups_against_all_pairs(spark):
    """Recall of the bands on a whole table: pairs of alike fingerprints that end up in one group."""
    prints = fp.fingerprint(documents(spark, SF001))
    rows = [(r.doc_id, r.n_chars, r.fingerprint) for r in prints.collect()]
    e, own = fp.Embedder(), {}
    table = fp.Prints(e, [n for _, n, _ in rows], [f for *_, f in rows])
    groups = {r.doc_id: r.near_group for r in fp.near_groups(prints).collect()}
    found = want = 0
    for k in range(len(rows)):
        others = np.arange(k + 1, len(rows))
        for x in others[table.alike(k, others, fp.ALIKE)].tolist() if len(others) else ():
            want += 1
            found += groups[rows[k][0]] == groups[rows[x][0]]
            own.setdefault(k, []).append(x)
    assert want > 100 and found >= 0.9 * want
    sample = random.Random(2).sample(sorted(own), 30)
    for k in sample:                         # the array form says what the plain one says
        assert all(e.likeness(rows[k][2], rows[k][1], rows[x][2], rows[x][1]) >= fp.ALIKE for x in own[k])
    alone = {groups[rows[k][0]] for k in range(len(rows))}
    assert len(alone) > len(rows) / 2        # strangers stay apart


@pytest.mark.parametrize("group", [fp.GROUP, 20])
def test_groups_of_large_bands(spark, group):
    """A chain of near copies and strangers, with bands of more nodes than a task holds."""
    dice = random.Random(5)
    text = [dice.choice("abcdefghij") for _ in range(400)]
    docs = []
    for k in range(120):
        docs.append((k, "".join(text)))
        text[dice.randrange(400)] = dice.choice("klmnop")
    docs += [(1_000 + k, "".join(dice.choice("abcdefghij") for _ in range(400))) for k in range(40)]
    prints = fp.fingerprint(spark.createDataFrame(docs, "doc_id long, text string"))
    groups = {r.doc_id: r.near_group for r in fp.near_groups(prints, group=group).collect()}
    assert {groups[k] for k in range(120)} == {0}
    assert {k: groups[k] for k in range(1_000, 1_040)} == {k: k for k in range(1_000, 1_040)}


def test_very_long_text_needs_few_places():
    e = fp.Embedder()
    assert len(e.sampled(e.level(4_000_000), 4 * 4_000_000)) < 1_000
    n = 300_000
    t = "some words of a very long text. " * (n // 32)
    own, other = e.both(t, t[:9], len(t) - 9)
    assert own.count(":") == 1 and 64 <= len(own) <= 2_000 and e.likeness(own, len(t), other, len(t)) > 0.9


def test_a_doc_id_with_several_texts_is_one_node(spark):
    rows = [(5, "abc " * 50), (3, "xyz, " * 40), (5, "xyz, " * 40), (9, "abc " * 50), (5, "other words"), (7, "other words")]
    prints = fp.fingerprint(spark.createDataFrame(rows, "doc_id long, text string"))
    got = fp.near_groups(prints).collect()
    assert sorted((r.doc_id, r.near_group) for r in got) == [(3, 3), (5, 3), (7, 3), (9, 3)]


def test_bands_meet_alike_pairs_wherever_they_differ():
    e, dice = fp.Embedder(), random.Random(6)
    words = ["".join(dice.choice("etaoinshrdlu") for _ in range(dice.randint(2, 8))) for _ in range(500)]
    for n_words, spans in ((300, 6), (40, 4), (12, 1), (4, 1)):
        alike = met = 0
        for span in range(spans):              # changes in one part of the text
            for _ in range(60):
                a = [dice.choice(words) for _ in range(n_words)]
                b, lo, hi = list(a), span * n_words // spans, (span + 1) * n_words // spans
                for _ in range(max(1, dice.choice((2, 5, 10, 15)) * n_words // 100)):
                    b[dice.randrange(lo, hi)] = dice.choice(words)
                a, b = " ".join(a), " ".join(b)
                f, g = (e.both(t, "", len(t))[0] for t in (a, b))
                if e.likeness(f, len(a), g, len(b)) >= fp.ALIKE:
                    alike += 1
                    met += bool(set(e.bands(f, len(a))) & set(e.bands(g, len(b))))
        assert alike >= 20 and met >= 0.97 * alike


# --- quality -----------------------------------------------------------------------

def test_quality_of_labelled_documents_kept_apart(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    out = {r.doc_id: r for r in q.op10_quality(spark, SF001).collect()}
    apart = [d for d in labels if d in out and zlib.crc32(str(d).encode()) % 5 == 0]
    assert sum(out[d].keep == bool(labels[d]) for d in apart) >= 0.95 * len(apart)
    assert all(0 <= r.score <= 1 for r in out.values())


def test_views_exchange_labels():
    dice = np.random.default_rng(1)
    y = dice.integers(0, 2, 400).astype(float)
    a, b = (np.column_stack([y * 3 + dice.normal(size=400), dice.normal(size=400)]) for _ in range(2))
    apart = np.arange(400) % 5 == 0
    pool_y = dice.integers(0, 2, 800)
    pool = [np.column_stack([pool_y * 3 + dice.normal(size=800), dice.normal(size=800)]) for _ in range(2)]
    first, second = q.co_train(a[:400], b[:400], y, apart, *pool)
    both = q.odds(pool[0], first) + q.odds(pool[1], second)
    alone = q.odds(pool[0], first)
    right = lambda z: ((z > 0) == pool_y).mean()
    assert right(both) > right(alone) > 0.85


def test_quality_defined_cases(spark):
    rows = [(1, None, None, None, None), (2, "", "s", "en", 0), (3, "some words here", "s", "en", 15),
            (3, "some words here", "s", "en", 15), (None, "x", None, "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long") \
        .withColumn("score", F.lit(3))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in q.score(docs, q.fit(docs, none)).collect()} == {0.5}
    some = spark.createDataFrame([(1, 0), (2, None), (3, 1), (3, 1), (99, 1)], "doc_id long, quality int")
    got = q.score(docs, q.fit(docs, some)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert q.score(docs.limit(0), None).collect() == []


def test_logistic_is_the_dense_solution():
    dice = np.random.default_rng(4)
    x = dice.normal(size=(300, 6)) * (dice.random((300, 6)) < 0.6)
    y = (x @ [1, -2, 0.5, 0, 1, 0] + dice.normal(size=300) > 0).astype(float)
    full = np.column_stack([x, np.ones(300)])
    ridge = np.array([1.0] * 6 + [1e-3])
    w = np.zeros(7)
    for _ in range(30):
        p = 1 / (1 + np.exp(-full @ w))
        w -= np.linalg.solve((full * (p * (1 - p))[:, None]).T @ full + np.diag(ridge), full.T @ (p - y) + ridge * w)
    assert np.allclose(q.logistic(x, y), w, atol=1e-4)


def test_text_view_by_hand():
    texts = ["One two ONE two three", "", "é é", "a"]
    data, offsets = "".join(texts).encode(), np.cumsum([0] + [len(t.encode()) for t in texts])
    rows = q.TextView()(np.frombuffer(data, np.uint8), offsets)
    assert len(rows) == 4 and rows.bounds[1] == rows.bounds[2]
    values = [rows.values[a:b][rows.slots[a:b] >= q.SHAPE] for a, b in zip(rows.bounds, rows.bounds[1:])]
    # one x 2, two x 2, three; one two x 2, two one, two three
    counts = np.log1p(np.array([2, 2, 1, 2, 1, 1]))
    assert np.allclose(sorted(values[0]), sorted(counts / np.linalg.norm(counts)))
    assert len(values[1]) == 0 and len(values[2]) == 2 and values[3].tolist() == [1.0]


def test_quality_is_read_from_the_words(spark):
    """Both kinds of text have the same letters, word lengths and metadata."""
    dice = np.random.default_rng(2)
    good = ["stone", "reads", "night", "least", "angel", "below", "study"]
    bad = ["notes", "dares", "thing", "slate", "glean", "elbow", "dusty"]
    rows = [(i, " ".join(dice.choice(good if i % 2 else bad, 30)), "s", "en", 179) for i in range(400)]
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    docs = spark.createDataFrame(rows + [(400, " ".join(good * 40_000), "s", "en", 179)], schema)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    got = {r.doc_id: r for r in q.score(docs, q.fit(docs, labels)).collect()}
    assert sum((got[i].p_text >= 0.5) == bool(i % 2) for i in range(200, 400)) >= 196
    assert got[400].keep and 0.4 < got[0].p_metadata < 0.6      # a very long text; nothing in the metadata


def test_quality_does_not_depend_on_the_order_of_repeated_rows(spark):
    rows = [(i, f"{'good' if i % 2 else 'bad'} word {i} {k}", "s", "en", 20) for i in range(40) for k in range(3)]
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    runs = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, schema).repartition(3)
        runs.append(sorted(map(tuple, q.score(docs, q.fit(docs, labels)).collect())))
    assert runs[0] == runs[1]


# --- licenses ----------------------------------------------------------------------

MODEL = lc.fit(["the house is old and the garden is large", "no news from the north"])


def probabilities(text):
    """Softmax of a paragraph's scores, by hand."""
    classes, weights, intercept = MODEL
    z = np.array(intercept)
    for g in lc.grams_of(lc.words_of(text)):
        z = z + np.array(weights.get(g, [0.0] * len(classes)))
    p = np.exp(z - z.max())
    return dict(zip(classes, p / p.sum()))


LINES = [("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("LICENSED UNDER CC BY 4.0", "cc-by"),
         ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
         ("Our tool was released under the MIT License last year", "mit"),
         ("Licensed under the Apache License, Version 2.0.", "apache"),
         ("All rights reserved. Copyright of the authors", "unknown"),
         ("My fishing licence expired", "unknown")]


def test_scan_equals_the_model_by_hand(spark):
    docs = spark.createDataFrame([(k, "intro words\n" + line + "\nmore words") for k, (line, _) in enumerate(LINES)],
                                 "doc_id long, text string").withColumn("paragraph", F.lit("x"))
    got = {r.doc_id: r for r in lc.scan(docs, MODEL).collect()}
    for k, (line, family) in enumerate(LINES):
        by_hand = probabilities(line)
        assert got[k].family == family == max(by_hand, key=by_hand.get) and got[k].paragraph == 1
        assert got[k].probability == pytest.approx(max(by_hand.values()), rel=1e-9)
        assert got[k].confirmed == (family != "unknown")


def test_scan_finds_every_license_line(spark):
    docs = documents(spark, SF001)
    known = ["Licensed under CC BY-NC 4.0.", "Released under the MIT License.",
             "Licensed under the Apache License, Version 2.0.",
             "This work is licensed under the GNU General Public License, version 3."]
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line"))
    want = {(r.doc_id, r.p) for r in lines.filter(F.col("line").isin(known)).collect()}
    out = lc.op6_license_scan(spark, SF001)
    assert {(r.doc_id, r.paragraph) for r in out.filter("confirmed").collect()} == want and want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_license_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, "no words of the kind"), (4, "licence"), (None, LINES[0][0]),
            (5, LINES[0][0]), (5, LINES[0][0]), (6, "word " * 50_000 + "under the MIT License")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.family, r.confirmed) for r in lc.scan(docs, MODEL).collect())
    assert [g[0] for g in got] == [0, 4, 5, 5, 6]
    assert got[1] == (4, "unknown", False) and got[0][1:] == got[2][1:] == ("cc-by-nc", True)
    assert lc.scan(docs.limit(0), MODEL).collect() == []


def test_names_alone_are_looked_at(spark):
    lines = [("Distributed under GPL-3.0-or-later", "gpl"), ("CC BY-SA 4.0", "cc-by-sa"),
             ("Released under Apache-2.0", "apache"), ("MPL 2.0", "mpl")]
    docs = spark.createDataFrame([(k, "intro\n" + t) for k, (t, _) in enumerate(lines)], "doc_id long, text string")
    assert {r.doc_id: (r.paragraph, r.family) for r in lc.scan(docs, MODEL).collect()} == \
        {k: (1, family) for k, (_, family) in enumerate(lines)}
    zero = spark.createDataFrame([(1, "CC0 1.0 Universal")], "doc_id long, text string")
    assert lc.scan(zero, MODEL).count() == 1     # returned, whatever the model says of so short a line
    every = [(k, t) for k, t in enumerate(t for ts in lc.TEMPLATES.values() for t in ts)]
    frame = spark.createDataFrame(every, "doc_id long, text string")
    assert {r.doc_id for r in lc.scan(frame, MODEL).filter("confirmed").collect()} == {k for k, _ in every}


def test_every_template_is_looked_at(spark):
    every = [(k, t) for k, t in enumerate(t for ts in lc.TEMPLATES.values() for t in ts)]
    frame = spark.createDataFrame(every, "doc_id long, text string")
    assert {r.doc_id for r in lc.scan(frame, MODEL).filter("confirmed").collect()} == {k for k, _ in every}


def test_common_words_are_no_names(spark):
    lines = ["Wir gehen mit dem Hund in den Garten.", "er kam mit", "Apaches and isc and gnu", "ACCENT CCX BSDX"]
    frame = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert lc.scan(frame, MODEL).collect() == []
    assert lc.scan(spark.createDataFrame([(1, "MIT"), (2, "x (GPL)")], "doc_id long, text string"), MODEL).count() == 2


def test_wrapped_notices_are_confirmed(spark):
    long = [(f, t) for f, ts in lc.TEMPLATES.items() for t in ts if len(t) > 100]
    docs = [(100 * width + k, "first line\n\n" + textwrap.fill(t, width) + "\n\nlast line")
            for width in (30, 72) for k, (_, t) in enumerate(long)]
    docs.append((1, "\n\n".join(textwrap.wrap(long[0][1], 20))))
    got = lc.scan(spark.createDataFrame(docs, "doc_id long, text string"), MODEL).filter("confirmed").collect()
    assert sorted((r.doc_id, r.paragraph, r.family) for r in got if r.doc_id > 1) == \
        [(100 * width + k, 2, f) for width in (30, 72) for k, (f, _) in enumerate(long)]
    assert not [r for r in got if r.doc_id == 1 and r.template_similarity > 0.99]


def test_a_sure_line_is_not_a_run_as_well(spark):
    mit = textwrap.fill(lc.TEMPLATES["mit"][1], 60)
    text = "Released under the MIT License.\n\nCopyright 2020 the authors\n\n" + mit + "\n\nend"
    both = "Licensed under CC BY 4.0.\nCopyright 2020 the authors\nlast words"
    prose = "\n".join("some words of no weight " * 3 for _ in range(20))
    inside = prose + "\n" + textwrap.fill(lc.TEMPLATES["bsd"][0], 72) + "\n" + prose
    docs = spark.createDataFrame([(1, text), (2, both), (3, inside)], "doc_id long, text string")
    got = sorted((r.doc_id, r.paragraph, r.family) for r in lc.scan(docs, MODEL).filter("confirmed").collect())
    assert got[:3] == [(1, 0, "mit"), (1, 4, "mit"), (2, 0, "cc-by")]
    assert [(d, f) for d, _, f in got[3:]] == [(3, "bsd")] and 20 - lc.REACH <= got[3][1] <= 20


def test_a_paragraph_that_is_a_part_of_a_short_template(spark):
    docs = spark.createDataFrame([(1, "under the MIT License")], "doc_id long, text string")
    row = lc.scan(docs, MODEL).first()
    size = len(lc.pairs_of(lc.words_of("Released under the MIT License.")))
    assert size == 4 and row.template_similarity == 1.0       # 3 of 3 of its own, 3 of 4 of the template's


def test_long_lines_take_time_in_proportion(spark):
    def seconds(n):
        docs = spark.createDataFrame([(1, "word " * n + "under the MIT License")], "doc_id long, text string")
        start = time.time()
        assert lc.scan(docs, MODEL).count() == 1
        return time.time() - start
    seconds(100)
    assert seconds(50_000) < 20
    many = spark.createDataFrame([(1, "licence\n" * 20_000)], "doc_id long, text string")
    start = time.time()
    assert lc.scan(many, MODEL).count() == 20_000 and time.time() - start < 60

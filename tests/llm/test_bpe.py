import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.conftest import SF0001
from watchfold.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
FILE = bpe.vocabulary_file()
CODEC = bpe.Codec(bpe.load_vocabulary(FILE))
LIBRARY = tokenizers.Tokenizer.from_file(FILE)


def ids(text):
    return np.frombuffer(CODEC.encode(text), "<u4").tolist()


def check(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids(text) == want
    assert CODEC.decode(CODEC.encode(text)) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library(text):
    check(text)


PIECES = ["a", "ab", "  ", "\n", "'s", "é", "ß", "日本", "😀", "<|endoftext|>", "<|endof", "!!!!", "-----", "=",
          "123", "\t", " the", "ing", "http://", "\x00", "\xa0", "a" * 20, "====="]


@pytest.mark.parametrize("seed", range(5))
def test_mixed_pieces_as_the_library(seed):
    dice = random.Random(seed)
    for _ in range(200):
        check("".join(dice.choice(PIECES) for _ in range(dice.randint(0, 40))))


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 5_000, " " * 20_000, "=-" * 5_000, "日本語" * 2_000,
                                  "".join(random.Random(1).choice("abcdefgh") for _ in range(20_000))])
def test_pre_tokens_beyond_the_lookahead(text):
    check(text)


def test_both_ways_of_encoding_agree_and_state_stays_small():
    for word in list(CODEC.cache)[:500]:
        data = word.encode()
        assert list(CODEC.machine.encode(data)) == CODEC.machine.encode_visible(data)
    emitted, longest = 0, 0
    stream = CODEC.machine.encode(iter(b"abcabd" * 5_000))
    for k, _ in enumerate(stream):
        emitted, longest = k, max(longest, CODEC.machine.lookahead)
    assert emitted > 1_000


def test_decoder_across_split_characters():
    out = CODEC.decode(b"".join(CODEC.encode(c) for c in "日é😀"))
    assert out == "日é😀"
    broken = np.frombuffer(CODEC.encode("é"), "<u4")[:1].tolist()
    assert CODEC.decode(np.array(broken, "<u4").tobytes()) == LIBRARY.decode(broken, skip_special_tokens=False)


def test_query_and_defined_cases(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    for r in bpe.op7_bpe(spark, SF0001).collect():
        want = LIBRARY.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    rows = spark.createDataFrame([(1, None, 3), (1, "", 3), (None, "x", 4), (2, "x", 4), (2, "x", 4)],
                                 "doc_id long, text string, n_tokens int")
    got = bpe.round_trip(rows, FILE).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded) for r in got) == [
        (0, 1, "x"), (1, 0, ""), (1, 0, ""), (2, 1, "x"), (2, 1, "x")]
    assert bpe.round_trip(rows.limit(0), FILE).collect() == []


def test_short_pre_tokens_build_one_trie_only():
    codec = bpe.Codec(bpe.load_vocabulary(bpe.vocabulary_file()))
    codec.encode("a few short words, 12 of them")
    assert "backward" not in vars(codec.machine)
    long = "ab" * codec.machine.lookahead
    assert codec.decode(codec.encode(long)) == long and "backward" in vars(codec.machine)

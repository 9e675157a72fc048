"""The corpus pipeline against its stages by brute force."""

import hashlib

import numpy as np
import pytest

import corpus_pipeline
from tests.conftest import SF0001
from tests.llm.test_ngram_join import brute_force as brute_components
from watchfold.llm import bpe, language_id


def cut(docs, width=100):
    """The texts without the bytes that a repeated string covers."""
    first, out = {}, {}
    pieces = {d: t.encode() for d, t in docs}
    for d in sorted(pieces):
        for p in range(len(pieces[d]) - width + 1):
            first.setdefault(pieces[d][p:p + width], (d, p))
    for d, s in pieces.items():
        gone = np.zeros(len(s), bool)
        for p in range(len(s) - width + 1):
            if first[s[p:p + width]] != (d, p):
                gone[p:p + width] = True
        kept = bytes(np.frombuffer(s, np.uint8)[~gone]).decode("utf-8", "ignore")
        if kept or not gone.any():
            out[d] = kept
    return out


def test_run_equals_brute_force(spark):
    tokenizers = pytest.importorskip("tokenizers")
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    named = {r.doc_id for r in language_id.accepted(docs).collect()}
    left = sorted((d, t) for d, t in texts.items() if d in named)
    left = _first(left)
    kept = cut(left)
    items = [r.text for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    kept = {d: t for d, t in kept.items() if not any(i in t for i in items)}
    library = tokenizers.Tokenizer.from_file(bpe.vocabulary_file())
    want = {}
    for d, t in kept.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want[d] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in corpus_pipeline.run(spark, SF0001).collect()}
    assert got == want


def _first(docs):
    component = brute_components(docs)
    return [(d, t) for d, t in docs if component[d][1] == d]


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF0001)
        assert out.collect() == []
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns


def test_stages_take_nulls_and_repeated_rows(spark):
    rows = [(1, "the house and the garden of the old town are here", "en", "s", 50), (2, None, "en", None, None),
            (None, "the house and the garden of another town are there", None, "s", 50), (3, "", None, None, 0),
            (1, "the house and the garden of the old town are here", "en", "s", 50)]
    rows += [(10 + k, f"the {k} streets of the town lead to the river and the {k} mills", "en", "t", 60)
             for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF0001)
    assert sum(r.doc_id == 1 for r in docs.collect()) == 1

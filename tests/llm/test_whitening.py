"""Embedding whitening against a dense eigendecomposition and exact arithmetic."""

import math

import numpy as np
import pytest

from watchfold.llm import whitening as wh

SCHEMA = "vec_id bigint, embedding array<float>, component string, whitened string, n string, x string"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows], SCHEMA).repartition(parts)


def ints_of(v):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]


def plain(rows, k):
    """(deviations, whitened up to sign, explained) with a dense eigendecomposition."""
    x = [ints_of(v) for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = np.array([[float(n * a - s) for a, s in zip(v, sums)] for v in x]) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = [j for j in range(min(k, len(values))) if values[j] > 1e-10 * values[0]]
    return deviation, centred @ vectors[:, keep] / np.sqrt(values[keep]), (values / values.sum())[keep]


def check(out, rows, k):
    deviation, white, explained = plain(rows, k)
    got = {}
    for r in out.collect():
        assert r.n == len(rows) and r.identity_error <= 1e-4
        got.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == len(rows)
    signs = None
    for (i, _), dev, w in zip(rows, deviation, white):
        own = got[i]
        assert sorted(own) == list(range(1, len(explained) + 1))
        assert {int(r.deviation) for r in own.values()} == {dev}
        mine = np.array([own[c].whitened for c in sorted(own)])
        if signs is None:
            signs = np.sign(mine * w)
        assert np.abs(mine * signs - w).max() < 1e-8
        assert np.allclose([own[c].explained for c in sorted(own)], explained, rtol=1e-9)


@pytest.mark.parametrize("spectrum", [
    np.linspace(1, 0.9, 64), 0.5 ** np.arange(60), np.ones(64), 1 + 1e-7 * np.arange(64), 1 / (1 + np.arange(150.0)),
    np.concatenate([[400.0], np.linspace(69, 48, 63)]), np.concatenate([np.ones(5), np.zeros(95)]), np.ones(1), np.arange(20.0)])
def test_leading_pairs_of_many_spectra(spectrum):
    d = len(spectrum)
    g = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0]
    v = (g * spectrum) @ g.T
    found = wh.leading_eigenpairs(lambda q: v @ q, d)
    want = np.sort(spectrum)[::-1][:wh.COMPONENTS]
    assert np.abs(found.values - want).max() <= 1e-12 * want[0]
    assert found.residual <= 1e-13
    assert np.abs(found.vectors.T @ found.vectors - np.eye(len(want))).max() < 1e-12
    assert np.abs(v @ found.vectors - found.vectors * found.values).max() < 1e-12 * want[0]


def test_filter_needs_few_passes():
    spectrum = np.concatenate([[400.0, 133.0], np.linspace(69, 48, 62)])
    g = np.linalg.qr(np.random.default_rng(1).normal(size=(64, 64)))[0]
    v = (g * spectrum) @ g.T
    passes = wh.leading_eigenpairs(lambda q: v @ q, 64).passes
    assert passes <= 50
    assert wh.leading_eigenpairs(lambda q: v @ q, 64, degree=2, patience=10**9).passes > passes


def test_lanczos_bound_is_near_the_spectrums_end():
    dice = np.random.default_rng(3)
    for _ in range(20):
        spectrum = np.sort(dice.uniform(1, 10, 50))
        g = np.linalg.qr(dice.normal(size=(50, 50)))[0]
        v, lanczos = (g * spectrum) @ g.T, wh.Lanczos(50, dice)
        for _ in range(8):
            lanczos.step(v @ lanczos.column())
        assert 0 <= lanczos.lower() <= spectrum[0] + 0.05 * (spectrum[-1] - spectrum[0])


def test_whitened_rows(spark):
    dice = np.random.default_rng(8)
    mix = dice.normal(size=(40, 40))
    rows = [(i, (0.1 * dice.normal(size=40) @ mix + 3).tolist()) for i in range(300)]
    check(wh.whitened(frame(spark, rows)), rows, 32)


def test_large_counts_are_exact():
    centre = wh.Centre.of([10 ** 12 * 1_000_000 + 7] * 3, 10 ** 12)
    x = np.array([[1_000_005, 999_990, 1_000_000]])
    want = sum((10 ** 12 * int(a) - (10 ** 18 + 7)) ** 2 for a in x[0])
    assert want > 2 ** 63 and centre.deviations(x - 0) == [want]
    assert np.allclose(centre.apply(x), [[5, -10, 0]], atol=1e-10)


def test_defined_cases(spark):
    dice = np.random.default_rng(9)
    rows = [(i, dice.normal(size=6).tolist()) for i in range(40)]
    dropped = [(100, None), (101, []), (102, [None] * 6), (103, [1.0] * 5 + [float("nan")]), (104, [float("-inf")] * 6),
               (None, None)]
    check(wh.whitened(frame(spark, rows + dropped)), rows, 32)            # fewer dimensions than components
    other = [(200 + i, dice.normal(size=3).tolist()) for i in range(10)]
    out = wh.whitened(frame(spark, rows + other))                         # two lengths: two fits
    check(out.filter("vec_id < 200"), rows, 32)
    check(out.filter("vec_id >= 200"), other, 32)
    few = [(i, dice.normal(size=30).tolist()) for i in range(5)]          # rank 4
    assert wh.whitened(frame(spark, few)).agg({"component": "max"}).first()[0] == 4
    assert wh.whitened(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    assert wh.whitened(frame(spark, rows).limit(0)).count() == 0
    assert wh.whitened(frame(spark, [(1, [0.5, 1.5])])).count() == 0
    twice = rows + [rows[0], (None, rows[1][1])]
    out = wh.whitened(frame(spark, twice))
    assert out.filter("vec_id = 0").count() == 12 and out.filter("vec_id IS NULL").count() == 6
    assert {r.n for r in out.select("n").distinct().collect()} == {42}
    with pytest.raises(Exception, match="2\\*\\*52"):
        wh.whitened(frame(spark, [(1, [1e30, 0.0]), (2, [0.0, 0.0])])).count()


def test_query(spark):
    from tests.conftest import SF0001
    out = wh.op12_whitening(spark, SF0001)
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
                                "whitened": "double", "explained": "double", "identity_error": "double"}
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    check(out, rows, 32)

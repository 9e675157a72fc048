"""Centroid clustering on bit planes against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from watchfold.llm import centroids as ce

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, distance string, v string, planes string"


def plain(rows, clusters=ce.CLUSTERS, rounds=ce.ROUNDS):
    """{(vec_id, vector): (cluster, distance)} and the centroids, in Python integers."""
    ints = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest())
    cents = [list(v) for _, v in sorted(ints, key=lambda r: (digest(r[0]), r[1]))[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cents))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in ints]
        for k in range(len(cents)):
            own = [v for (_, v), c in zip(ints, of) if c == k]
            if own:
                cents[k] = [sum(col) // len(own) for col in zip(*own)]
    return [(i, near(v)[1], near(v)[0]) for i, v in ints], cents


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


@pytest.mark.parametrize("low,high", [(0, 0), (-1, 0), (0, 1), (-8, 7), (-9, 8), (-ce.LARGEST, ce.LARGEST - 1)])
def test_planes_hold_the_integers(low, high):
    planes = ce.plane_count(low, high)
    dice = np.random.default_rng(2)
    v = dice.integers(low, high + 1, (40, 64))
    v[0], v[1] = low, high
    x = ce.pack(v, planes)
    big = v.astype(object)
    assert (ce.square(x) == (big * big).sum(1)).all()
    assert (ce.dot(x, x[:5]) == big @ big[:5].T).all()
    cluster = dice.integers(0, 4, 40) * 2                # odd numbers are empty
    sums, sizes = ce.bit_sums(x, cluster, 8)
    assert (sums == [v[cluster == k].sum(0) for k in range(8)]).all() and (sizes == np.bincount(cluster, minlength=8)).all()
    c, d = ce.nearest(x, x[:5])
    diff = ((big[:, None] - big[None, :5]) ** 2).sum(2)
    assert (d == diff.min(1)).all() and (c == [int(np.argmin(r)) for r in diff.tolist()]).all()


def test_clusters_and_defined_cases(spark):
    dice = np.random.default_rng(4)
    rows = [(i, dice.normal(0, 0.4, 64).tolist()) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(30)] + [rows[3], rows[3], (None, rows[5][1]), (None, rows[9][1])]
    rows += [(7, rows[50][1]), (300, [0.0] * 64), (301, [0.0] * 64)]                    # an id twice; ties
    rows += [(400, None), (401, []), (402, [0.1] * 63), (403, [0.1] * 65), (404, [None] + [0.1] * 63),
             (405, [float("nan")] * 64), (406, [0.1] * 63 + [float("inf")]), (None, None)]
    df = spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows], SCHEMA).repartition(5)
    assigned, cents = ce.cluster_vectors(df)
    want, want_cents = plain(rows)
    assert cents == want_cents
    assert assigned.columns == ["vec_id", "cluster", "distance"]
    assert order(tuple(r) for r in assigned.collect()) == order(want)
    few, _ = ce.cluster_vectors(df.filter("vec_id < 5"))                                # fewer vectors than centroids
    assert order(tuple(r) for r in few.collect()) == order(plain([r for r in rows if r[0] is not None and r[0] < 5])[0])
    for nothing in (df.limit(0), df.filter("vec_id = 400")):
        assert [r.count() if hasattr(r, "columns") else r for r in ce.cluster_vectors(nothing)] == [0, []]
    large = spark.createDataFrame([(1, [1e9] * 64, "", "", "", "")], SCHEMA)
    with pytest.raises(ValueError, match="2\\*\\*27"):
        ce.cluster_vectors(large)


def test_query_columns(spark):
    from tests.conftest import SF0001
    out = ce.op11_centroid_clusters(spark, SF0001)
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{SF0001}/embeddings.parquet").count()
    assert {r.inertia for r in rows} == {sum(r.distance for r in rows)}
    by = {}
    for r in rows:
        by.setdefault(r.cluster, []).append(r)
    assert all({r.cluster_inertia for r in own} == {sum(r.distance for r in own)} for own in by.values())
    assert len({r.centroid_sha256 for r in rows}) == len(by)

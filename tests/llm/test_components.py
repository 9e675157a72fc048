import random

import pytest

from watchfold.llm.components import connected_components


@pytest.mark.parametrize("seed,nodes,links", [(1, 60, 40), (2, 200, 150), (3, 40, 200), (4, 30, 0)])
def test_equals_union_find(spark, seed, nodes, links):
    dice = random.Random(seed)
    pairs = [(dice.randrange(nodes) - 5, dice.randrange(nodes) - 5) for _ in range(links)]
    pairs += [(1000 + k, 1001 + k) for k in range(30)]                    # a long chain
    pairs += [(2000, 2000 + k) for k in range(1, 50)] + [(7, 7)]          # a star, a loop
    parent = {x: x for p in pairs for x in p if p[0] != p[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent} and len(got) == len(parent)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_checkpoint_leaves_no_shuffle_files(spark):
    import time

    from watchfold.llm import common

    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().endswith(".data")}
    before, setting = shuffles(), spark.conf.get(common.SHUFFLE_CLEANUP, None)
    rows = spark.range(5_000).repartition(7, "id").groupBy("id").count()
    kept = common.materialise(rows)
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before and kept.count() == 5_000 and rows.count() == 5_000
    assert spark.conf.get(common.SHUFFLE_CLEANUP, None) == setting

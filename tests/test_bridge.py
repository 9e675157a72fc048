import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from watchfold.operators import analytics as an
from watchfold.operators.bridge import bridge_synth
from watchfold.plans.registry import fact_behavior, fact_interaction


def check_invariants(bridge, n_users_in, n_contracts_in):
    rows = bridge.collect()
    pairs = [(r.user_id, r.contract_id) for r in rows]
    assert len(pairs) == len(set(pairs)), "duplicate pair"
    per_contract, per_user, primaries = {}, {}, {}
    for r in rows:
        per_contract[r.contract_id] = per_contract.get(r.contract_id, 0) + 1
        per_user[r.user_id] = per_user.get(r.user_id, 0) + 1
        primaries[r.contract_id] = primaries.get(r.contract_id, 0) + int(r.is_primary)
        assert str(r.start_date) == "2022-04-01" and str(r.end_date) == "2026-12-12"
    assert all(1 <= n <= 5 for n in per_contract.values())
    assert all(n <= 5 for n in per_user.values())
    assert all(p == 1 for p in primaries.values())
    assert len(per_contract) <= n_contracts_in
    assert len(per_user) <= n_users_in
    return per_contract, per_user


def test_bridge_on_fixture_dims(spark):
    users = an.dim_user(fact_behavior(spark, SF001))
    contracts = an.dim_contract(fact_interaction(spark, SF001))
    bridge = bridge_synth(users, contracts, seed=3)
    per_contract, _ = check_invariants(bridge, users.count(), contracts.count())
    assert len(per_contract) == contracts.count()          # enough users for every contract
    again = bridge_synth(users, contracts, seed=3)
    assert sorted(map(tuple, bridge.collect())) == sorted(map(tuple, again.collect()))


@pytest.mark.parametrize("n_users", [1, 3, 7])
def test_bridge_few_users(spark, n_users):
    users = spark.range(n_users).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"))
    contracts = spark.range(50).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("contract"))
    bridge = bridge_synth(users, contracts, seed=11)
    _, per_user = check_invariants(bridge, n_users, 50)
    assert sum(per_user.values()) == 5 * n_users            # users run out: every slot used


def test_bridge_bounds_only_when_asked(spark):
    users = spark.range(300).select(F.col("id").cast("string").alias("user_id"))
    contracts = spark.range(100).select(F.col("id").cast("string").alias("contract"))
    per_contract, per_user = check_invariants(
        bridge_synth(users, contracts, seed=1, n_users=40, n_contracts=20), 40, 20)
    assert len(per_contract) == 20
    per_contract, _ = check_invariants(bridge_synth(users, contracts, seed=1), 300, 100)
    assert len(per_contract) == 100


def test_bridge_links_every_contract_of_large_dimensions(spark):
    users = spark.range(50_000).select(F.col("id").cast("string").alias("user_id"))
    contracts = spark.range(20_000).select(F.col("id").cast("string").alias("contract"))
    bridge = bridge_synth(users, contracts)
    assert bridge.select("contract_id").distinct().count() == 20_000
    assert bridge.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 5


def test_bridge_empty(spark):
    users = spark.createDataFrame([], "user_id string")
    contracts = spark.createDataFrame([("c1",)], "contract string")
    assert bridge_synth(users, contracts).count() == 0


def test_global_positions_and_running_sum_match_brute_force(spark):
    from watchfold.operators.bridge import global_positions, running_sum
    rows = spark.range(500).select(
        F.xxhash64(F.lit(7), F.col("id")).alias("h"), (F.col("id") % 5 + 1).alias("d"))
    numbered = global_positions(rows, ["h"])
    assert numbered.rdd.getNumPartitions() >= 1
    summed = running_sum(numbered, "d", "acc", block=7).orderBy("pos").collect()
    brute = sorted(rows.collect(), key=lambda r: r.h)
    assert [r.pos for r in summed] == list(range(500))
    assert [r.h for r in summed] == [r.h for r in brute]
    acc = 0
    for got, want in zip(summed, brute):
        acc += want.d
        assert got.acc == acc

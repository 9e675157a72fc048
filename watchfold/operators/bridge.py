"""Synthetic user <-> contract bridge rows for demos.

Rules: each sampled contract gets 1 to 5 users (fewer when users run out), a
user sits in at most 5 contracts, no (user, contract) pair repeats, and each
contract has exactly one primary user.

Construction; "random" means ordered by ``md5(seed:key)``, which is the same in every
run, task and SQL engine:

1. users and contracts are numbered in md5 order, all of them unless ``n_users`` or
   ``n_contracts`` asks for the first so many;
2. demand: contract c wants ``md5(seed+2:c)`` (first 8 hex digits) modulo 5, plus 1,
   users (at most N, the number of users); a running sum of the demands in contract
   order hands contract c the slot range ``[S_c - d_c, S_c)``;
3. slot s holds user number ``s mod N``; slots from ``5 * N`` on are cut, so a
   user fills at most five slots (``u, u + N, ...``) and, since a contract spans
   at most N consecutive slots, never twice in one contract;
4. primary: the user with the smallest ``md5(seed+3:user)`` within each contract.

Numbering and running sum are distributed (range partitions with per-partition
offsets, blocks with per-block offsets): only one row per partition or block is
broadcast. The numbered keys are written to the checkpoint folder while the plan
is built, since their numbers depend on the partitioning: building this frame
runs jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchfold.functions.constants import (
    BRIDGE_END_DATE,
    BRIDGE_MAX_LINKS,
    BRIDGE_START_DATE,
)
from watchfold.session import ensure_checkpoint_dir

BRIDGE_SCHEMA = ("user_id string, contract_id string, start_date date, "
                 "end_date date, is_primary boolean")


# Rows per block of the distributed running sum; each block is one window partition.
RUNNING_SUM_BLOCK = 100_000

def global_positions(df: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos``, the rows numbered 0..N-1 in ``order``, without a one-partition window.

    Range partitioning spreads the sorted rows over tasks; each task numbers its
    own rows (``monotonically_increasing_id`` is partition << 33 plus the row
    in the partition), and a partition's offset is the number of rows in all
    earlier partitions, from one count per partition (broadcast: one row per
    partition). The ids depend on the partitioning, so the numbered rows are
    checkpointed before anything reads them twice.
    """
    ranged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_id", F.monotonically_increasing_id())
              .checkpoint())
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
               .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")))
    in_part = F.col("_id") - F.shiftleft(F.col("_part").cast("bigint"), 33)
    return (ranged.join(F.broadcast(offsets), "_part")
            .withColumn("pos", (F.col("_offset") + in_part).cast("bigint"))
            .drop("_part", "_id", "_offset"))


def running_sum(df: DataFrame, value: str, out: str, pos: str = "pos",
                block: int = RUNNING_SUM_BLOCK) -> DataFrame:
    """Add ``out``, the running sum of ``value`` in ``pos`` order (``pos`` = 0..N-1).

    Rows are cut into blocks of ``block`` positions: a window per block sums
    within it, and the block's offset is the sum of all earlier blocks (one
    row per block, broadcast).
    """
    blocked = df.withColumn("_block", F.floor(F.col(pos) / block))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (blocked.groupBy("_block").agg(F.sum(value).alias("_total"))
               .select("_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")))
    within = Window.partitionBy("_block").orderBy(pos).rowsBetween(Window.unboundedPreceding,
                                                                   Window.currentRow)
    return (blocked.join(F.broadcast(offsets), "_block")
            .withColumn(out, F.col("_offset") + F.sum(value).over(within))
            .drop("_block", "_offset"))


def seeded(seed: int, key: str) -> Column:
    """The key's place in the seeded order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def _numbered(keys: DataFrame, key: str, seed: int, n: int | None) -> DataFrame:
    """``key`` and ``pos``: the non-NULL keys in seeded order, all or the first ``n``."""
    hashed = (keys.select(F.col(key).cast("string").alias(key)).dropna()
              .withColumn("h", seeded(seed, key)))
    if n is not None:
        hashed = hashed.orderBy("h", key).limit(n)
    return global_positions(hashed, ["h", key]).select(key, "pos")


def bridge_synth(users: DataFrame, contracts: DataFrame, seed: int = 42,
                 n_users: int | None = None, n_contracts: int | None = None,
                 max_links: int = BRIDGE_MAX_LINKS) -> DataFrame:
    """Bridge rows ``user_id, contract_id, start_date, end_date, is_primary``.

    ``users`` needs a ``user_id`` column, ``contracts`` a ``contract`` column.
    """
    ensure_checkpoint_dir(users.sparkSession)
    numbered = _numbered(users, "user_id", seed, n_users)
    n = numbered.count()
    if n == 0:
        return users.sparkSession.createDataFrame([], BRIDGE_SCHEMA)
    capacity = max_links * n
    drawn = F.conv(F.substring(seeded(seed + 2, "contract"), 1, 8), 16, 10).cast("bigint")
    demand = F.least(drawn % max_links + 1, F.lit(n).cast("bigint"))
    wanted = _numbered(contracts, "contract", seed + 1, n_contracts).withColumn("d", demand)
    slots = (running_sum(wanted, "d", "slot_end")
             .withColumn("slot_start", F.col("slot_end") - F.col("d"))
             .filter(F.col("slot_start") < capacity)
             .select(F.col("contract").alias("contract_id"),
                     F.explode(F.sequence(F.col("slot_start"),
                                          F.least(F.col("slot_end"), F.lit(capacity)) - 1))
                      .alias("slot")))
    linked = (slots.withColumn("pos", F.col("slot") % n).join(numbered, "pos")
              .select("user_id", "contract_id")
              # One exchange on the contract serves both the dedupe and the
              # primary-user window; a contract has at most five rows.
              .repartition("contract_id")
              .dropDuplicates(["user_id", "contract_id"]))
    primary = Window.partitionBy("contract_id").orderBy(seeded(seed + 3, "user_id"), F.col("user_id"))
    return linked.select(
        "user_id", "contract_id",
        F.to_date(F.lit(BRIDGE_START_DATE)).alias("start_date"),
        F.to_date(F.lit(BRIDGE_END_DATE)).alias("end_date"),
        (F.row_number().over(primary) == 1).alias("is_primary"),
    )

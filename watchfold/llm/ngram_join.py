"""N-gram Jaccard join: adaptive multi-match prefixes, exact.

A document is the set of its distinct word shingles, ordered by their 64-bit
hash. If two sets overlap in at least ``a`` shingles, the first ``n - a + m`` of
each share at least ``m`` (the m-prefix rule). How long a document's prefix gets
depends on the cost its shingles would cause: from a sample of the documents the
frequent shingles are estimated, and a document whose prefix holds many of them
gets a longer one (a larger ``m``). After the shuffle, shingles that really occur
in over ``HOT`` sets are left out, and a pair must share ``m`` minus the left-out
ones of the document with the smaller ``m``: each set leaves out its longest lists of so
many shingles less one, and a pair that shares enough still meets in its rarest shared list. Only documents for which that is
nothing (those made of frequent shingles alone) meet through frequent shingles,
and only with each other. The sample decides about cost, never about the result.

Equal sets are one node from the start, however many copies there are. Pairs are
not expanded within a group: first each list of sets that share a shingle is
verified against one hub; then only pairs from different components so far are
enumerated, counted and verified. The work of a large group of near copies is
linear in its size. What rules a pair out before its sets are compared: their sizes, a hub
of both, and the parity of their shingles in ``1 << CELL_BITS`` cells (sets that differ in
more cells than similar sets can differ in shingles).

Defined cases: a null text, an empty one or one without words has 0 shingles and
is linked with nothing; fewer words than a shingle make one shingle of the whole
sequence; a null ``doc_id`` counts as the smallest; repeated rows of one ``doc_id`` are the
same node and come back once each; a table without rows gives no rows; a text of any length is one
set; other columns are ignored. Shingles of two sets are compared by 64-bit hashes, sets are told apart by 128 bits.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from watchfold.llm.common import (
    WordHasher,
    bucket_slices,
    doc_groups,
    give_back,
    materialise,
    mix64,
    read_table,
    release,
    row_bounds,
    run_starts,
    shuffle_parts,
    text_buffer,
)
from watchfold.llm.components import connected_components
from watchfold.llm.repeats import NO_ID, keyed, unkeyed

SHINGLE = 5
SIMILAR = (80, 100)              # links at 100 * intersection >= 80 * union
SAMPLE_SHARE = 0.2               # documents whose shingles estimate the cost,
SAMPLE_EVERY = 8                 # and of them one shingle in so many (by its hash)
SAMPLE_COUNT = 3                 # a shingle this often in the sample counts as frequent
FREQUENT_MAX = 500_000           # bound of the broadcast estimate (8 bytes each)
HOT = 64                         # sets that share a shingle, beyond which it is left out
LEVELS = (0.05, 0.15, 0.4)       # m as a share of n; the last resort is the whole set
SMALL = 400                      # sets under this size start at the second level
WHOLE = 64                       # sets up to this size are sent whole
SHINGLES_PER_TASK = 600_000
TASK_LIST = 4_096                # active sets of a list whose pairs one task looks at; lists of more are joined
GUESTS = 1_024                   # passive sets that lie with a list's active ones, about
LIST_WORK = 4_000_000            # pairs to look at in lists that lie together, beyond which they are dealt out
PAIRS_AT_ONCE = 1_000_000        # in one numpy operation
CELL_BITS = 10                   # of the cells in which the parity of a set's shingles is kept
PARITY = [f"odd{k}" for k in range((1 << CELL_BITS) // 64)]
ID_BITS = 64                     # of a set's first hash; fewer in tests, to make sets clash
SECOND = 0x9E3779B97F4A7C15      # salt of the second
NO_CLASH = np.zeros(0, np.int64)


def shingle_hashes(hasher: WordHasher, data: np.ndarray, offsets: np.ndarray, size: int):
    """Distinct shingles of a group of rows: (row, hash) sorted by row and hash."""
    words, rows, _, _ = hasher(data, offsets)
    counts = np.diff(row_bounds(rows, len(offsets) - 1))
    first = np.cumsum(counts) - counts
    hashes, owners = [], []
    for width in range(1, size + 1):       # shorter ones only for rows with that few words
        if len(words) < width:
            break
        if width == size:
            at = np.flatnonzero(rows[:len(rows) - width + 1] == rows[width - 1:])
        else:
            at = first[counts == width]
        h = np.full(len(at), width, np.uint64)
        for k in range(width):
            h = h * np.uint64(0xD6E8FEB86659FD93) + words[at + k]
        hashes.append(mix64(h))
        owners.append(rows[at])
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, row = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    kept = run_starts(row, h)
    return row[kept], h[kept]


def set_hashes(h: np.ndarray, bounds: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of each row's set of shingles."""
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix64(h + np.uint64(salt)), out=sums[1:])
    total = sums[bounds[1:]] - sums[bounds[:-1]]
    return mix64(total + np.diff(bounds).astype(np.uint64)).view(np.int64)


def set_ids(h: np.ndarray, bounds: np.ndarray, clashing: np.ndarray) -> np.ndarray:
    """One id per row's set of shingles: its first hash or, where different sets are known to have
    that in common (``clashing``, sorted), its second. Two sets have one id only if 128 bits agree."""
    ids = set_hashes(h, bounds, 1) >> (64 - ID_BITS)
    if len(clashing):
        clash = np.isin(ids, clashing)
        if clash.any():
            ids = np.where(clash, set_hashes(h, bounds, SECOND), ids)
    return ids


def parities(row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    """For each row the cells that hold an odd number of its shingles, as 64-bit words. Where the
    cells of two sets differ, a shingle is in one of them only, so they differ in at least as many."""
    cell, count = np.unique((row << CELL_BITS) + (h >> np.uint64(64 - CELL_BITS)).astype(np.int64),
                            return_counts=True)
    odd = np.zeros(rows << CELL_BITS, bool)
    odd[cell[count % 2 == 1]] = True
    return np.packbits(odd).view(np.int64).reshape(rows, len(PARITY))


def least_overlap(n: np.ndarray, similar=SIMILAR) -> np.ndarray:
    return -(-n * similar[0] // similar[1])


def prefix_matches(h, bounds, frequent, similar=SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """(m, level) of each row: the shortest level whose prefix holds clearly fewer frequent
    shingles; the level after the last is the whole set."""
    n = np.diff(bounds)
    overlap = np.maximum(least_overlap(n, similar), 1)
    matches = [np.minimum(np.maximum(1, np.ceil(f * n).astype(np.int64)), overlap) for f in LEVELS] + [overlap]
    level = np.where(n <= WHOLE, len(LEVELS), np.where(n < SMALL, 1, 0))
    m = np.choose(level, matches)
    if len(frequent) and len(h):
        at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
        seen = np.concatenate([[0], np.cumsum(frequent[at] == h)]) * SAMPLE_EVERY
        for longer in range(1, len(matches)):
            costly = seen[bounds[:-1] + np.minimum(n, n - overlap + m)] - seen[bounds[:-1]]
            level = np.where((2 * costly >= m) & (level < longer), longer, level)
            m = np.choose(level, matches)
    return m, level


def each_group(batches, size: int):
    """For every group of rows: (batch, lo, hi, row, hash, bounds)."""
    hasher = WordHasher(lower=True)
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        for lo, hi in doc_groups(offsets):
            own = offsets[lo:hi + 1] - offsets[lo]
            row, h = shingle_hashes(hasher, data[offsets[lo]:offsets[hi]], own, size)
            yield batch, lo, hi, row, h, row_bounds(row, hi - lo)
    give_back()


def frequent_shingles(docs: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """Shingles that are frequent in a sample of the documents, at most FREQUENT_MAX."""
    sample = docs.filter(F.pmod(F.xxhash64(F.lit("cost"), "doc_id"), F.lit(10_000))
                         < int(SAMPLE_SHARE * 10_000)).select("text")

    def tokens(batches):
        for batch in batches:
            every = [h for *_, h, _ in each_group([batch], size)]
            every = [h[h % np.uint64(SAMPLE_EVERY) == 0] for h in every]
            h, n = np.unique(np.concatenate(every), return_counts=True) if every else ((), ())
            yield pa.RecordBatch.from_pydict({"h": pa.array(np.asarray(h, np.uint64).view(np.int64)),
                                              "n": pa.array(np.asarray(n, np.int64))})

    top = (sample.mapInArrow(tokens, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
           .filter(F.col("n") >= SAMPLE_COUNT).orderBy(F.desc("n"), "h").limit(FREQUENT_MAX))
    return np.sort(top.select("h").toPandas()["h"].to_numpy(np.int64).view(np.uint64))


def describe(docs: DataFrame, frequent, size: int = SHINGLE, similar=SIMILAR) -> DataFrame:
    """doc_id, n_shingles, set_id and the set's second hash, m, its level and the parities of each row."""
    def run(batches):
        for batch, lo, hi, row, h, bounds in each_group(batches, size):
            m, level = prefix_matches(h, bounds, frequent.value, similar)
            odd = parities(row, h, hi - lo)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id")[lo:hi].cast(pa.int64()),
                "n_shingles": pa.array(np.diff(bounds)),
                "set_id": pa.array(set_ids(h, bounds, NO_CLASH)),
                "second": pa.array(set_hashes(h, bounds, SECOND)),
                "m": pa.array(m), "level": pa.array(level.astype(np.int64)),
                **{c: pa.array(odd[:, k].copy()) for k, c in enumerate(PARITY)}})

    return docs.select("doc_id", "text").mapInArrow(
        run, ", ".join(f"{c} long" for c in ["doc_id", "n_shingles", "set_id", "second", "m", "level", *PARITY]))


def distinct_sets(info: DataFrame) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """``info`` and its distinct sets by their final ids, and the first hashes that different sets
    share, as their second hashes tell: about n * n / 2 ** 65 of n sets (3 of 1e10, 271 of 1e11)."""
    def grouped(rows):
        return materialise(rows.filter("n_shingles > 0").groupBy("set_id").agg(
            F.min("doc_id").alias("first_doc"), F.max("n_shingles").alias("n"), F.max("m").alias("m"),
            F.max("level").alias("level"), (F.min("second") != F.max("second")).alias("clash"),
            *[F.max(c).alias(c) for c in PARITY]))

    sets = grouped(info)
    clashing = np.sort(sets.filter("clash").select("set_id").toPandas()["set_id"].to_numpy(np.int64))
    if len(clashing):
        shared = info.sparkSession.createDataFrame([(int(x),) for x in clashing], "set_id long").withColumn(
            "again", F.lit(True))
        info = materialise(info.join(F.broadcast(shared), "set_id", "left").withColumn(
            "set_id", F.when(F.col("again"), F.col("second")).otherwise(F.col("set_id"))).drop("again"))
        sets = grouped(info)
    return info.drop("second"), sets.drop("clash"), clashing


def shared_lists(docs: DataFrame, frequent, parts: int, clashing=NO_CLASH, size: int = SHINGLE,
                 similar=SIMILAR) -> DataFrame:
    """(list_id, set_id, n_shared, size): the sets that share prefix shingles; shingles with
    the same list of sets are one row per set. Shingles travel in blocks, one per bucket."""
    buckets = parts

    def send(batches):
        for batch in batches:
            tokens, sets = [], []
            for _, lo, hi, row, h, bounds in each_group([batch], size):
                ids, n = set_ids(h, bounds, clashing), np.diff(bounds)
                length = n - least_overlap(n, similar) + prefix_matches(h, bounds, frequent.value, similar)[0]
                first = np.zeros(len(n), bool)       # equal sets of this group travel once
                first[np.unique(ids, return_index=True)[1]] = True
                taken = (np.arange(len(h)) - bounds[row] < length[row]) & first[row]
                tokens.append(h[taken])
                sets.append(ids[row[taken]])
            if not tokens:
                continue
            tokens, sets = np.concatenate(tokens), np.concatenate(sets)
            order, cut = bucket_slices((tokens % np.uint64(buckets)).astype(np.int64), buckets)
            tokens, sets = tokens[order], sets[order]
            full = np.flatnonzero(np.diff(cut))
            for part in np.array_split(full, max(1, len(full) // 256)):
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(part, pa.int32()),
                    "tokens": pa.array([tokens[cut[k]:cut[k + 1]].tobytes() for k in part], pa.binary()),
                    "sets": pa.array([sets[cut[k]:cut[k + 1]].tobytes() for k in part], pa.binary())})

    def meet(batches):
        tokens, sets = [], []
        for batch in batches:
            tokens += [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("tokens")]
            sets += [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("sets")]
        if not tokens:
            return
        tokens, sets = np.concatenate(tokens), np.concatenate(sets)
        order = np.lexsort((sets, tokens))
        tokens, sets = tokens[order], sets[order]
        kept = run_starts(tokens, sets)
        tokens, sets = tokens[kept], sets[kept]
        start = np.flatnonzero(run_starts(tokens))
        count = np.diff(np.append(start, len(tokens)))
        names = np.add.reduceat(mix64(sets.view(np.uint64)), start) + count.astype(np.uint64)
        several = count > 1
        names, one, times = np.unique(names[several], return_index=True, return_counts=True)
        start, count = start[several][one], count[several][one]
        for lo in range(0, len(names), 5_000):       # one list each, written out set by set
            n, s = count[lo:lo + 5_000], start[lo:lo + 5_000]
            at = np.repeat(s - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield pa.RecordBatch.from_pydict({
                "list_id": pa.array(np.repeat(names[lo:lo + 5_000], n).view(np.int64)),
                "set_id": pa.array(sets[at]),
                "n_shared": pa.array(np.repeat(times[lo:lo + 5_000], n).astype(np.int64)),
                "size": pa.array(np.repeat(n, n).astype(np.int64))})

    blocks = docs.select("text").mapInArrow(send, "bucket int, tokens binary, sets binary")
    lists = blocks.repartitionById(parts, "bucket").mapInArrow(
        meet, "list_id long, set_id long, n_shared long, size long")
    return lists.groupBy("list_id", "set_id").agg(F.sum("n_shared").alias("n_shared"),
                                                  F.max("size").alias("size"))


def shingle_sets(docs: DataFrame, wanted: DataFrame, clashing=NO_CLASH, size: int = SHINGLE) -> DataFrame:
    """(set_id, shingles) of the documents ``wanted`` (doc_id, set_id); sorted 64-bit hashes."""
    def run(batches):
        for batch, lo, hi, row, h, bounds in each_group(batches, size):
            ids = set_ids(h, bounds, clashing)
            own = ids == batch.column("set_id")[lo:hi].to_numpy()     # not a namesake's text
            yield pa.RecordBatch.from_pydict({
                "set_id": pa.array(ids[own]),
                "shingles": pa.array([h[bounds[k]:bounds[k + 1]].tobytes() for k in np.flatnonzero(own)],
                                     pa.binary())})

    return (docs.select("doc_id", "text").join(wanted, "doc_id").select("set_id", "text")
            .mapInArrow(run, "set_id long, shingles binary").dropDuplicates(["set_id"]))


def verify(pairs: DataFrame, similar=SIMILAR) -> DataFrame:
    """The pairs (a, b), with their sets x and y, that are similar enough, by exact counts."""
    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate([x, y])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(similar[1] * shared >= similar[0] * (len(both) - shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.mapInArrow(run, "a long, b long")


SIGNATURE = ["gone0", "gone1", "more0", "more1"]


def cells(tokens: np.ndarray) -> list[int]:
    """Which of 128 cells hold one of the tokens, as two 64-bit masks."""
    cell = (tokens >> np.uint64(57)).astype(np.int64)
    masks = np.zeros(2, np.uint64)
    np.bitwise_or.at(masks, cell >> 6, np.uint64(1) << (cell & 63).astype(np.uint64))
    return masks.view(np.int64).tolist()


def compare_with_hubs(stars: DataFrame, nodes: DataFrame, docs: DataFrame, clashing, size: int, similar) -> DataFrame:
    """For pairs of a hub ``a`` and a set ``b``: whether they are linked, the hub's size, how many
    shingles the hub lacks, and in which cells the hub's shingles are ``gone`` from the set or
    the set has ``more``. Two sets of one hub cannot share what either lacks of it."""
    def run(batches):
        for batch in batches:
            rows = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                gone, more = (u[~np.isin(u, v, assume_unique=True)] for u, v in ((x, y), (y, x)))
                shared = len(x) - len(gone)
                rows.append((similar[1] * shared >= similar[0] * (len(x) + len(more)), len(x), len(more),
                             *cells(gone), *cells(more)))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(columns[0], pa.bool_()),
                 *(pa.array(c, pa.int64()) for c in columns[1:])],
                names=["a", "b", "linked", "hub_n", "extra", *SIGNATURE])

    return materialise(_with_sets(materialise(stars), nodes, docs, clashing, size).mapInArrow(
        run, "a long, b long, linked boolean, hub_n long, extra long, " + ", ".join(f"{c} long" for c in SIGNATURE)))


def _with_sets(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, clashing, size: int) -> DataFrame:
    wanted = (pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
              .join(nodes.select("set_id", F.col("first_doc").alias("doc_id")), "set_id"))
    sets = shingle_sets(docs, wanted, clashing, size)
    return (pairs.select("a", "b")
            .join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y")), "b"))


def deal_lists(labelled: DataFrame, least_tasks: int) -> tuple[DataFrame, int]:
    """The lists with sets of different components, dealt to groups (``home``, ``part``) that a task looks at,
    and the number of tasks. Two sets that are kept here for lower levels than their own (or guests) never
    meet, as ``meets`` says: a list's ``passive`` sets meet its active ones only. Where passive sets are many,
    they are dealt to parts by their hash, the same in all lists of a home, and the active sets go to each. A list
    is ``long``, and joined instead, if it has more than ``TASK_LIST`` active sets."""
    passive, active, idle = ~F.col("short") & (F.col("guest") | (F.col("level") > F.col("top"))), F.col("active"), F.col("idle")
    labelled = labelled.withColumn("passive", passive)
    mixed = labelled.groupBy("list_id").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("set_id").alias("home"),
        F.count_if(~F.col("passive")).alias("active"), F.count_if("passive").alias("idle")).filter("lo <> hi AND active > 0")
    halvings = F.greatest(F.ceil(F.log2(F.greatest(idle, F.lit(1)) / GUESTS)), F.lit(0))
    mixed = materialise(mixed.withColumns({
        "long": active > TASK_LIST, "chunks": F.pow(F.lit(2), halvings).cast("int"),
        "looks": (active + 50) * (active + F.least(idle, F.lit(GUESTS))),
        "every": (active + 50) * (active + idle)}).drop("lo", "hi"))
    work = mixed.groupBy("home").agg(F.sum("looks").alias("work"), F.sum("every").alias("every"))
    to_do = work.agg(F.coalesce(F.sum("every"), F.lit(0))).first()[0]
    mixed = mixed.join(work.drop("every"), "home").select(
        "list_id", "home", "long", "chunks",
        F.pmod(F.xxhash64("list_id"), F.ceil(F.col("work") / LIST_WORK)).alias("part"))
    chunks = (F.when(F.col("long"), F.array(F.lit(0)))
              .when(F.col("passive"), F.array(F.pmod(F.xxhash64("set_id"), F.col("chunks")).cast("int")))
              .otherwise(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = labelled.join(mixed, "list_id").withColumn("chunk", F.explode(chunks)).withColumn(
        "part", F.when(F.col("chunk") == 0, F.col("part")).otherwise(F.xxhash64("part", "chunk")))
    return materialise(dealt.drop("chunk", "chunks")), max(least_tasks, -(-to_do // LIST_WORK))


def crossing_pairs(lists: DataFrame, facts: DataFrame, parts: int, similar) -> DataFrame:
    """(a, b): sets of one list (of at most ``TASK_LIST`` active sets and about ``GUESTS`` passive ones) in different
    components that can be similar by what is known of them. Lists of one ``home`` and ``part`` lie together, with what is known of each
    of their sets once, so a pair that shares many lists is passed on about once. The number of
    tasks is given, for their bytes say little about the pairs in them."""
    own = lists.select("home", "part", "list_id", "set_id", "top", "guest", "passive")
    known = own.select("home", "part", "set_id").distinct().join(facts, "set_id")
    rows = own.unionByName(known, allowMissingColumns=True)
    columns = ["home", "part", "list_id", "set_id", "top", "guest", "passive", *FACTS]

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                new = {c: batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in columns}
                new |= {f"{c}_known": batch.column(c).is_valid().to_numpy(zero_copy_only=False)
                        for c in ("list_id", "hub")}
                held = {c: np.concatenate([held[c], v]) for c, v in new.items()} if held else new
            if not held or not len(held["home"]):
                continue
            groups = run_starts(held["home"], held["part"])
            done = len(groups) if batch is None else int(np.flatnonzero(groups)[-1])
            if done:
                pairs = _pairs_of({c: v[:done] for c, v in held.items()}, np.cumsum(groups[:done]), similar)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
            held = {c: v[done:] for c, v in held.items()}

    return (rows.repartition(parts, "home", "part").sortWithinPartitions("home", "part", F.asc_nulls_first("list_id"), "passive")
            .select(*[F.col(c).cast("long").alias(c) for c in columns]).mapInArrow(run, "a long, b long"))


def _pairs_of(held: dict[str, np.ndarray], group: np.ndarray, similar) -> np.ndarray:
    """The distinct pairs of some groups of lists, smaller set first."""
    member = held["list_id_known"]
    sets, code = np.unique(held["set_id"], return_inverse=True)
    code = group * len(sets) + code
    facts = {c: held[c][~member] for c in ["set_id", *FACTS, "hub_known"]}
    order = np.argsort(code[~member])
    at = order[np.searchsorted(code[~member][order], code[member])]
    lists, top, guest = held["list_id"][member], held["top"][member], held["guest"][member].astype(bool)
    starts = np.flatnonzero(run_starts(group[member], lists))
    ends = np.append(starts[1:], len(lists))
    partners = np.repeat(ends, ends - starts) - 1 - np.arange(len(lists))
    partners[held["passive"][member].astype(bool)] = 0       # they come last in a list and do not meet each other
    found, waiting, width = [np.zeros(0, np.int64)], 0, len(order)
    step = max(1, PAIRS_AT_ONCE // (TASK_LIST + 2 * GUESTS))
    for lo in range(0, len(lists), step):
        count = partners[lo:lo + step]
        a = np.repeat(np.arange(lo, lo + len(count)), count)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
        x, y = at[a], at[b]
        level = np.minimum(facts["level"][x], facts["level"][y])
        meets = (level <= np.minimum(top[a], top[b])) & ~(guest[a] | guest[b])
        meets |= (facts["short"][x] | facts["short"][y]).astype(bool)
        meets &= facts["component"][x] != facts["component"][y]
        x, y = x[meets], y[meets]
        pair = np.unique(np.minimum(x, y) * width + np.maximum(x, y))
        found.append(pair[_can_be_similar(facts, pair // width, pair % width, similar)])
        waiting += len(found[-1])
        if waiting > PAIRS_AT_ONCE:
            found, waiting = [np.unique(np.concatenate(found))], 0
    pair = np.unique(np.concatenate(found))
    x, y = facts["set_id"][pair // max(width, 1)], facts["set_id"][pair % max(width, 1)]
    return np.stack([np.minimum(x, y), np.maximum(x, y)], 1)


def _can_be_similar(f: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, similar) -> np.ndarray:
    """Whether the facts do not rule out the pairs of rows ``a``, ``b``."""
    n = f["n"][a] + f["n"][b]
    good = np.minimum(f["n"][a], f["n"][b]) * similar[1] >= np.maximum(f["n"][a], f["n"][b]) * similar[0]
    differ = sum(_bits(f[c][a] ^ f[c][b]) for c in PARITY)
    good &= sum(similar) * differ <= (similar[1] - similar[0]) * n
    one_hub = f["hub_known"][a] & f["hub_known"][b] & (f["hub"][a] == f["hub"][b])
    lost = sum(_bits(f[g][a] | f[g][b]) for g in ("gone0", "gone1"))
    own = sum(_bits(f[g][a] & ~f[g][b]) for g in ("more0", "more1"))
    most = f["hub_n"][a] - lost + np.minimum(f["extra"][a] - own, f["extra"][b])
    return good & (~one_hub | (sum(similar) * most >= similar[0] * n))


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64)).astype(np.int64)


def components(docs: DataFrame, size: int = SHINGLE, similar=SIMILAR) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row."""
    spark = docs.sparkSession
    docs = keyed(docs)
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, size))
    info, sets, clashing = distinct_sets(materialise(describe(docs, frequent, size, similar)))
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(shuffle_parts(spark), -(-total // SHINGLES_PER_TASK))
    lists = materialise(shared_lists(docs, frequent, parts, clashing, size, similar)
                        .withColumn("hot", F.col("size") > HOT))
    release(spark)                              # here and below: shuffles that are over
    hot_shared = lists.filter("hot").groupBy("set_id").agg(F.sum("n_shared").alias("left_out"))
    overlap = F.ceil(F.col("n") * similar[0] / similar[1])
    nodes = materialise(sets.join(hot_shared, "set_id", "left").fillna(0, ["left_out"])
                        .withColumn("dense", F.expr("left_out > 0 AND 4 * (left_out + 1) >= 3 * m"))
                        .withColumn("short", F.col("dense") & (F.col("m") < overlap)))
    facts = nodes.select("set_id", "n", "m", "level", "left_out", "dense", "short")
    rows = lists.join(facts, "set_id")
    with_short = rows.filter("hot AND short").select("list_id").distinct()
    # Similar sets that were sent at levels of at least f share f * n - 1 shingles here or more
    # (n of either), so each can do without one less than that in the order of shrinking lists
    # and still keep the rarest shared one. ``top`` is the highest level for which a list is
    # kept; the long lists of a common passage are not kept for the levels that matter.
    longest_first = Window.partitionBy("set_id").orderBy(F.desc("size"), F.desc("list_id"))
    missing = F.when(F.col("dense"), 0).otherwise(F.col("left_out"))
    last = len(LEVELS)
    every = Window.partitionBy("set_id")
    own = rows.filter("NOT hot OR dense").withColumns({
        "until": F.sum("n_shared").over(longest_first),
        "central": F.sum(F.col("size") * F.col("n_shared")).over(every) / F.col("n")})
    top = F.lit(-1)
    for level, share in enumerate([*LEVELS, similar[0] / similar[1]]):
        least = F.greatest(F.lit(1), F.ceil(F.lit(share) * F.col("n")) - 1 - missing)
        top = F.when((F.col("level") >= level) & (F.col("until") >= least), level).otherwise(top)
    own = own.withColumn("top", F.when(F.col("short"), last).otherwise(top)).drop("until")
    guests = rows.filter("hot AND NOT dense").join(with_short, "list_id", "left_semi")
    usable = materialise(own.withColumn("guest", F.lit(False)).unionByName(
        guests.withColumns({"top": F.lit(last), "guest": F.lit(True), "central": F.lit(0.0)})))
    own = usable.filter("NOT guest")

    # A hub for each list, the pairs with which it shares much; any choice is right here. The
    # set whose shingles are the most common is the likeliest original of near copies.
    hubs = own.groupBy("list_id").agg(F.max(F.struct("central", "set_id", "n")).alias("hub"))
    near = (F.least("n", "hub_n") * similar[1] >= F.greatest("n", "hub_n") * similar[0])
    stars = (own.join(hubs, "list_id")
             .select(F.col("hub.set_id").alias("a"), F.col("hub.n").alias("hub_n"),
                     F.col("set_id").alias("b"), "n", "m", "dense", "n_shared")
             .filter("a <> b").filter(near).groupBy("a", "b")
             .agg(F.sum("n_shared").alias("shared"), F.max("m").alias("m"), F.max("dense").alias("dense"))
             .filter(F.col("dense") | (2 * F.col("shared") >= F.col("m")))
             .groupBy("b").agg(F.max(F.struct("shared", "a")).alias("best")).select(F.col("best.a").alias("a"), "b"))
    compared = compare_with_hubs(stars, nodes, docs, clashing, size, similar)
    release(spark)
    links = compared.filter("linked").select("a", "b")
    parted = connected_components(links)

    # What is left: pairs from different components that share enough of their prefixes.
    label = F.coalesce("component", "set_id").alias("component")
    by_hub = compared.select(F.col("b").alias("set_id"), F.col("a").alias("hub"), "hub_n", "extra", *SIGNATURE)
    of_sets = parted.withColumnRenamed("node", "set_id")
    labelled = (usable.join(of_sets, "set_id", "left")
                .select("list_id", "set_id", "level", "n", "short", "guest", "top", label))
    open_lists, tasks = deal_lists(labelled, shuffle_parts(spark))
    set_facts = (nodes.select("set_id", "n", "level", "short", *PARITY).join(of_sets, "set_id", "left")
                 .withColumn("component", F.coalesce("component", "set_id")).join(by_hub, "set_id", "left"))
    long_lists = (open_lists.filter("long").join(by_hub, "set_id", "left")
                  .join(nodes.select("set_id", *PARITY), "set_id"))
    joined = ["set_id", "n", "level", "short", "guest", "passive", "top", "component", "hub", "hub_n", "extra", *SIGNATURE, *PARITY]
    left = long_lists.filter("NOT passive").select("list_id", *[F.col(c).alias(f"{c}_a") for c in joined])
    right = long_lists.select("list_id", *[F.col(c).alias(f"{c}_b") for c in joined])
    meets = F.col("short_a") | F.col("short_b") | (
        (F.least("level_a", "level_b") <= F.least("top_a", "top_b")) & ~F.col("guest_a") & ~F.col("guest_b"))
    # Of one hub: what both have of it, and of what it lacks, at most.
    lost = sum((F.bit_count(F.col(f"gone{k}_a").bitwiseOR(F.col(f"gone{k}_b"))) for k in (0, 1)), F.lit(0))
    own_extra = sum((F.bit_count(F.col(f"more{k}_a").bitwiseAND(F.bitwise_not(F.col(f"more{k}_b"))))
                     for k in (0, 1)), F.lit(0))
    most = F.col("hub_n_a") - lost + F.least(F.col("extra_a") - own_extra, F.col("extra_b"))
    possible = (sum(similar) * most >= similar[0] * (F.col("n_a") + F.col("n_b")))
    differ = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in PARITY), F.lit(0))
    meets = (meets & F.coalesce((F.col("hub_a") != F.col("hub_b")) | possible, F.lit(True))
             & (sum(similar) * differ <= (similar[1] - similar[0]) * (F.col("n_a") + F.col("n_b"))))
    crossing = (left.join(right, "list_id").filter("(passive_b OR set_id_a < set_id_b) AND component_a <> component_b")
                .filter(F.least("n_a", "n_b") * similar[1] >= F.greatest("n_a", "n_b") * similar[0])
                .filter(meets).select(F.least("set_id_a", "set_id_b").alias("a"), F.greatest("set_id_a", "set_id_b").alias("b")))
    crossing = crossing.union(crossing_pairs(open_lists.filter("NOT long"), set_facts, tasks, similar)).distinct()
    rest = materialise(verify(_with_sets(materialise(crossing), nodes, docs, clashing, size), similar))
    release(spark)
    final = connected_components(links.union(rest))

    first = (nodes.join(final.withColumnRenamed("node", "set_id"), "set_id", "left")
             .select("set_id", "first_doc", F.coalesce("component", "set_id").alias("component")))
    smallest = first.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    by_set = first.join(smallest, "component").select("set_id", "component_id")
    release(spark)
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return unkeyed(info.join(by_set, "set_id", "left").select(
        "doc_id", "n_shingles", F.when(component != NO_ID, component).alias("component_id")))


def first_of_each(docs: DataFrame, size: int = SHINGLE, similar=SIMILAR) -> DataFrame:
    """The rows of the document with the smallest id of every component, once each."""
    key, text_key, kept_key = "__id", "__text", "__kept"
    kept = (components(docs, size, similar).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.coalesce("doc_id", F.lit(NO_ID)).alias(kept_key)).distinct())
    rows = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                             text_key: F.xxhash64("text")})
    # repeated rows meet by the join's own partitioning
    return (rows.join(kept, F.col(key) == F.col(kept_key), "left_semi")
            .dropDuplicates([key, text_key]).select(*docs.columns))


FACTS = ["n", "level", "short", "component", "hub", "hub_n", "extra", *SIGNATURE, *PARITY]


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(read_table(spark, sf_dir, "documents"))


QUERIES = {"op4_ngram_join": op4_ngram_join}

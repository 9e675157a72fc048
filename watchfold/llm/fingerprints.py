"""Document fingerprints: a randomised edit embedding, sampled, banded and verified.

A text is walked once along shared random bits (CGK embedding, see
:mod:`watchfold.llm.cgk`): texts at a small edit distance have walks at a small
Hamming distance. The fingerprint samples the walk at shared random places, so
many per length that a text has between ``SAMPLES`` and twice as many; a longer
text's places are a subset of a shorter one's. It is a string: the number of
steps, a colon, one hexadecimal digit per place. The likeness of two fingerprints
is the share of the longer text's places at which both digits agree.

Near groups: texts of one length and fingerprint are one node (known by a 64-bit
hash of both). Bands of neighbouring places, over the whole walk, are the keys under
which nodes meet: (band, node) rows are sorted and streamed, and what stands alone in its band ends there.
The fingerprints then go to the bands that are left, where all nodes of a band are compared in
one go, and each is passed on with the first node that verified links connect it to, never the pairs.
A band of more than ``GROUP`` nodes is not held by one task: its nodes are compared with the
smallest one, and then only those outside of the largest group so far with all others, in chunks that a
task can hold. No pair of a band in different groups is left out.

The next document (ascending doc_id) is found without a global sort: ids are
range partitioned, the smallest of each range is known, and the texts go to their
range plus, for the smallest ones, to the range before as a guest.

Defined cases: a null text counts as empty (0 characters, fingerprint ``0:``); two
empty texts are alike (1), an empty and another are not (0); a null doc_id comes
first; rows of one doc_id are ordered by text and come back each, as one node of
the near groups; the only document is its own next; a table without rows gives no
rows; other columns are ignored. A text may be of any length: of its walk only the
sampled places are kept, some hundreds whatever its length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchfold.llm.cgk import walk_steps
from watchfold.llm.common import materialise, mix64, read_table, release, run_starts, shuffle_parts
from watchfold.llm.components import connected_components
from watchfold.llm.repeats import NO_ID, keyed, unkeyed

SAMPLES = 128                    # places of a fingerprint at least (for texts that long)
PERIOD = 1 << 14                 # steps after which the random bits repeat
BAND_PLACES = 12                 # neighbouring places of a band
SHORT_BANDS = [1, 2, 2, 3, 4, 6, 8]   # the same for walks of 1, 2-3, 4-7, ... 64-127 steps
ALIKE = 0.6                      # likeness of verified pairs
BYTES_PER_TASK = 8_000_000
GROUP = 4_096                    # nodes of a band that one task holds
STRETCH = 1 << 20                # places of a walk looked at in one go
DIGITS = "0123456789abcdef"
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


class Embedder:
    """Fingerprints of texts."""

    def __init__(self):
        self.steps = walk_steps(0, PERIOD)
        self.places: dict[int, list[int]] = {}
        self.reach = 0
        digits = mix64(np.arange(1 << 16, dtype=np.uint64) + np.uint64(5)) >> np.uint64(60)
        self.digit = [[DIGITS[v] for v in row] for row in digits.reshape(256, 256).tolist()]

    def level(self, n_chars: int) -> int:
        """Every 2**level-th place is sampled for a text of this length."""
        return max(0, (2 * n_chars // SAMPLES).bit_length() - 1) if n_chars else 0

    def sampled(self, level: int, steps: int) -> list[int]:
        """Sampled places of a level, at least up to ``steps``, and an end mark."""
        if steps > self.reach:
            self.reach, self.places = 2 * steps, {}
        if level not in self.places:
            found: list[int] = []
            for low in range(0, self.reach + 1, STRETCH):
                at = np.arange(low, min(low + STRETCH, self.reach + 1))
                found += at[in_level(at, level)].tolist()
            self.places[level] = [*found, 1 << 62]
        return self.places[level]

    @staticmethod
    def symbols(text: str) -> bytes:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return (codes * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).tobytes()

    def walk(self, symbols: bytes, places: list[int], step: int = 0, k: int = 0):
        """(steps, index of the next place, digits) after walking on from a state."""
        steps, digit, mask, out = self.steps, self.digit, PERIOD - 1, []
        place = places[k]
        for c in symbols:
            step += steps[c][step & mask]
            while place < step:
                out.append(digit[c][place & 255])
                k += 1
                place = places[k]
        return step, k, out

    def _places(self, n: int):
        return self.sampled(self.level(n), 4 * n + PERIOD)

    def both(self, text: str, edit: str, kept: int) -> tuple[str, str]:
        """Fingerprints of the text and of its first ``kept`` characters followed by ``edit``."""
        n = kept + len(edit)
        symbols, edit = self.symbols(text), self.symbols(edit)
        while True:
            places = self._places(len(text))
            step, k, head = self.walk(symbols[:kept], places)
            end, _, tail = self.walk(symbols[kept:], places, step, k)
            own = f"{end:x}:{''.join(head)}{''.join(tail)}"
            if self.level(n) != self.level(len(text)):
                step, k, head = self.walk(symbols[:kept], self._places(n))
            other, _, tail = self.walk(edit, self._places(n), step, k)
            if max(end, other) <= self.reach:
                return own, f"{other:x}:{''.join(head)}{''.join(tail)}"
            self.sampled(self.level(n), max(end, other))   # a walk of very long steps: sample further

    def likeness(self, a: str, n_a: int, b: str, n_b: int) -> float:
        """Share of the places of the longer walk at which both agree."""
        if a == b:
            return 1.0
        if not n_a or not n_b:
            return 0.0
        level = max(self.level(n_a), self.level(n_b))
        x, y = (self._digits(f, n, level) for f, n in ((a, n_a), (b, n_b)))
        shared, longer = min(len(x), len(y)), max(len(x), len(y))
        return float(np.count_nonzero(x[:shared] == y[:shared]) / longer) if longer else 0.0

    def _digits(self, fingerprint: str, n: int, level: int) -> np.ndarray:
        """The digits at the places of a level that is no finer than the fingerprint's."""
        steps, digits = fingerprint.split(":")
        own = np.frombuffer(digits.encode(), np.uint8)
        if self.level(n) == level:
            return own
        return own[in_level(np.array(self.sampled(self.level(n), int(steps, 16))[:len(own)]), level)]

    def bands(self, fingerprint: str, n_chars: int) -> np.ndarray:
        """Keys of the text's bands, at its own level and the next coarser one. Short walks
        have levels of their own, with fewer places a band the shorter they are."""
        (steps, digits), own = fingerprint.split(":"), self.level(n_chars)
        if not digits:
            return np.array([-1])
        values = np.frombuffer(bytes.fromhex(digits + "0" * (len(digits) % 2)), np.uint8)
        values = np.stack([values >> 4, values & 15], 1).ravel()[:len(digits)].astype(np.uint64)
        if not own and len(digits) < 1 << len(SHORT_BANDS):
            size = len(digits).bit_length() - 1
            keys = [self.band_keys(values, size - len(SHORT_BANDS), SHORT_BANDS[size])]
            size += 1
            if size < len(SHORT_BANDS):
                keys.append(self.band_keys(values, size - len(SHORT_BANDS), SHORT_BANDS[size]))
            else:
                keys.append(self.band_keys(values, 0, BAND_PLACES))
        else:
            places = np.array(self.sampled(own, int(steps, 16))[:len(digits)], np.int64)
            keys = [self.band_keys(values, own, BAND_PLACES),
                    self.band_keys(values[in_level(places, own + 1)], own + 1, BAND_PLACES)]
        return np.concatenate(keys)

    @staticmethod
    def band_keys(values: np.ndarray, level: int, size: int) -> np.ndarray:
        n = len(values) // size
        packed = values[:n * size].reshape(n, size) @ (np.uint64(16) ** np.arange(size, dtype=np.uint64))
        band = np.arange(n, dtype=np.uint64) + np.uint64((level + len(SHORT_BANDS)) << 32)
        return mix64(packed + mix64(band)).view(np.int64)


def in_level(places: np.ndarray, level: int) -> np.ndarray:
    """Which places a level samples; those of a coarser one are a subset."""
    return mix64(places.astype(np.uint64) + np.uint64(77)) & np.uint64((1 << level) - 1) == 0


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows by bucket of doc_id, each bucket followed by the row after it as a guest:
    (bucket, guest, doc_id, text), and the number of partitions to use."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(shuffle_parts(spark), -(-size // BYTES_PER_TASK))

    def ends(batches):
        low = None
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            if len(ids):
                low = ids.min() if low is None else min(low, ids.min())
        yield pa.RecordBatch.from_pydict({"low": pa.array([] if low is None else [int(low)], pa.int64())})

    lows = (docs.select("doc_id").distinct().repartitionByRange(4 * parts, "doc_id").mapInArrow(ends, "low long")
            .toPandas()["low"].sort_values().to_numpy(np.int64))
    if not len(lows):
        lows = np.zeros(1, np.int64)

    def deal(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            own = np.searchsorted(lows, ids, "right") - 1
            first = np.flatnonzero(lows[own] == ids)
            take = pa.array(np.concatenate([np.arange(len(ids)), first]))
            bucket = np.concatenate([own, (own[first] - 1) % len(lows)])
            guest = np.concatenate([np.zeros(len(ids), bool), np.ones(len(first), bool)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32()), pa.array(guest), batch.column(0).take(take), batch.column(1).take(take)],
                names=["bucket", "guest", "doc_id", "text"])

    return docs.mapInArrow(deal, "bucket int, guest boolean, doc_id long, text string"), parts


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    dealt, parts = with_next(keyed(docs))
    ordered = dealt.repartitionById(parts, "bucket").sortWithinPartitions("bucket", "guest", "doc_id", "text")

    def run(batches):
        embedder = Embedder()
        before = None                          # (bucket, guest, id, text) of the row before
        waiting = None                         # what is known about it but the likeness to the next
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                bucket, guest, doc_id, text = row
                text = text or ""
                if waiting is not None and waiting[0] == bucket:
                    _, last_id, last = waiting
                    n = len(last)
                    edit = text[:n // 4]
                    edited = last[:n - n // 4] + edit
                    own, other = embedder.both(last, edit, n - n // 4)
                    if before is not None:     # complete the row whose next was this one
                        out.append(before + (embedder.likeness(before[3], before[1], own, n),))
                        before = None
                    line = (last_id, n, hashlib.sha256(edited.encode()).hexdigest(), own, other,
                            embedder.likeness(own, n, other, len(edited)))
                    if guest:
                        out.append(line + (embedder.likeness(own, n, embedder.both(text, "", len(text))[0], len(text)),))
                        waiting = None
                        continue
                    before = line
                if not guest:
                    waiting = (bucket, doc_id, text)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=[f.split()[0] for f in RESULT.split(", ")])

    return unkeyed(ordered.mapInArrow(run, RESULT))


def banded(nodes: DataFrame) -> DataFrame:
    """(band, node) for every band of the nodes."""
    def bands(batches):
        embedder = Embedder()
        for batch in batches:
            keys = [np.unique(embedder.bands(text, n)) for n, text in
                    zip(batch.column("n_chars").to_pylist(), batch.column("fingerprint").to_pylist())]
            take = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)), batch.column("node").take(take)],
                names=["band", "node"])

    return nodes.select("node", "n_chars", "fingerprint").mapInArrow(bands, "band long, node long")


def meeting(rows: DataFrame, limit: int) -> DataFrame:
    """(band, node, large) of the bands with several nodes; large: with more than ``limit``."""
    def run(batches):
        band, node, large = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in _and_last(batches):
            last = batch is None
            if not last:
                band = np.concatenate([band, batch.column("band").to_numpy()])
                node = np.concatenate([node, batch.column("node").to_numpy()])
            if not len(band):
                continue
            starts = np.flatnonzero(run_starts(band))
            sizes = np.diff(np.append(starts, len(band)))
            whole = sizes > limit                       # or the rest of one that has been passed on
            whole[0] |= large == band[0]
            closed = np.ones(len(starts), bool)
            closed[-1] = last
            out = np.repeat((closed & (sizes > 1)) | whole, sizes)
            yield pa.RecordBatch.from_arrays([pa.array(band[out]), pa.array(node[out]),
                                              pa.array(np.repeat(whole, sizes)[out])], names=["band", "node", "large"])
            large = int(band[-1]) if whole[-1] else None
            keep = len(band) if closed[-1] or whole[-1] else starts[-1]
            band, node = band[keep:], node[keep:]

    return rows.repartition("band").sortWithinPartitions("band").mapInArrow(run, "band long, node long, large boolean")


def _and_last(batches):
    yield from batches
    yield None


class Prints:
    """The fingerprints of some nodes as arrays, to be compared many at a time."""

    def __init__(self, embedder: Embedder, n_chars: list[int], prints: list[str]):
        self.embedder, self.n_chars, self.prints = embedder, n_chars, prints
        self.level = np.array([embedder.level(n) for n in n_chars])
        self.code = np.unique(np.array(prints, object).astype(str), return_inverse=True)[1].ravel()
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def table(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(digits padded with 0, their number) of the nodes of this level or a finer one."""
        if level not in self.tables:
            own = [self.embedder._digits(f, n, level) if at <= level else np.zeros(0, np.uint8)
                   for f, n, at in zip(self.prints, self.n_chars, self.level.tolist())]
            lengths = np.array([len(d) for d in own])
            digits = np.zeros((len(own), max(1, lengths.max())), np.uint8)
            digits[np.arange(digits.shape[1]) < lengths[:, None]] = np.concatenate(own)
            self.tables[level] = digits, lengths
        return self.tables[level]

    def alike(self, one: int, others: np.ndarray, least: float) -> np.ndarray:
        """Which of ``others`` are alike to ``one``, as :meth:`Embedder.likeness` says."""
        out = self.code[others] == self.code[one]
        levels = np.maximum(self.level[others], self.level[one])
        for level in np.unique(levels).tolist():
            at = np.flatnonzero(levels == level)
            digits, lengths = self.table(level)
            mine, theirs = digits[one], digits[others[at]]
            longer = np.maximum(lengths[others[at]], lengths[one])
            shared = ((theirs == mine) & (mine != 0)).sum(1)
            out[at] |= shared / np.maximum(longer, 1) >= least
        return out

    def against(self, n_chars: int, fingerprint: str, least: float) -> list[int]:
        """Which nodes are alike to a fingerprint from elsewhere."""
        probe = Prints(self.embedder, [n_chars], [fingerprint])
        out = np.array([f == fingerprint for f in self.prints], bool)
        levels = np.maximum(self.level, probe.level[0])
        for level in np.unique(levels).tolist():
            at = np.flatnonzero(levels == level)
            digits, lengths = self.table(level)
            mine, length = probe.table(level)
            width = min(digits.shape[1], mine.shape[1])
            shared = ((digits[at, :width] == mine[0, :width]) & (mine[0, :width] != 0)).sum(1)
            out[at] |= shared / np.maximum(np.maximum(lengths[at], length[0]), 1) >= least
        return np.flatnonzero(out).tolist()

    def forest(self, least: float) -> list[tuple[int, int]]:
        """(first, other): each node with the first one of those it is connected to by alike pairs.
        First ones are the same in most bands, so stars of different bands are few links."""
        waiting, links = np.arange(len(self.n_chars)), []
        while len(waiting):
            first, border, waiting = int(waiting[0]), [int(waiting[0])], waiting[1:]
            while border and len(waiting):
                one = border.pop()
                hit = self.alike(one, waiting, least)
                links += [(first, int(x)) for x in waiting[hit]]
                border += waiting[hit].tolist()
                waiting = waiting[~hit]
        return links


def _runs(batches, columns: list[str]):
    """Lists of the columns for each run of equal values of the first, of sorted rows."""
    held: list[list] = [[] for _ in columns]
    for batch in _and_last(batches):
        if batch is not None:
            for have, name in zip(held, columns):
                have += batch.column(name).to_pylist()
        keys = held[0]
        if not keys:
            continue
        starts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
        done = starts if batch is None else starts[:-1]
        for lo, hi in zip(done, done[1:]):
            yield [have[lo:hi] for have in held]
        held = [have[done[-1]:] for have in held]


def _edges(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def small_band_links(live: DataFrame, nodes: DataFrame, alike: float) -> DataFrame:
    """(a, b): links among the nodes of each band, which one task holds."""
    def run(batches):
        embedder = Embedder()
        for _, node, n_chars, prints in _runs(batches, ["band", "node", "n_chars", "fingerprint"]):
            links = Prints(embedder, n_chars, prints).forest(alike)
            if links:
                yield _edges([(node[x], node[y]) for x, y in links])

    return (live.join(nodes.select("node", "n_chars", "fingerprint"), "node").repartition("band")
            .sortWithinPartitions("band", "node").select("band", "node", "n_chars", "fingerprint")
            .mapInArrow(run, "a long, b long").distinct())


def large_band_links(live: DataFrame, nodes: DataFrame, links: DataFrame, alike: float, group: int) -> DataFrame:
    """(a, b): links of nodes that share a band of more than ``group``, beyond ``links``."""
    hubs = live.groupBy("band").agg(F.min("node").alias("a"))
    stars = live.join(hubs, "band").filter("a <> node").select("a", F.col("node").alias("b")).distinct()
    found = alike_pairs(stars, nodes, alike)
    parted = connected_components(links.union(found))
    rows = materialise(live.join(parted, "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("component")))
    largest = (rows.groupBy("band", "component").agg(F.count("*").alias("n"))
               .groupBy("band").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("total"))
               .select("band", F.col("main.component").alias("main"),
                       F.ceil((F.col("total") - F.col("main.n")) * 2 / group).cast("int").alias("chunks"))
               .filter("chunks > 0"))
    rows = rows.join(largest, "band")
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    apart = rows.filter("component <> main").select("band", chunk.alias("chunk"), F.lit(0).alias("side"), "node")
    every = rows.select("band", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                        F.lit(1).alias("side"), "node")

    def run(batches):
        embedder, key, node, n_chars, prints, table = Embedder(), None, [], [], [], None
        for batch in batches:
            links = []
            for band, chunk_of, side, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (band, chunk_of):
                    key, node, n_chars, prints, table = (band, chunk_of), [], [], [], None
                if side == 0:                    # the chunk's own nodes come first
                    node.append(row[0])
                    n_chars.append(row[1])
                    prints.append(row[2])
                    continue
                if table is None:
                    table, top = Prints(embedder, n_chars, prints), list(range(len(node)))
                hits = table.against(row[1], row[2], alike)
                for x in hits:                   # links to the first, and between what was not joined yet
                    if x == hits[0] or top[x] != top[hits[0]]:
                        if node[x] != row[0]:
                            links.append((row[0], node[x]))
                        old = top[x]
                        top = [top[hits[0]] if t == old else t for t in top]
            if links:
                yield _edges(links)

    pieces = apart.unionByName(every).join(nodes.select("node", "n_chars", "fingerprint"), "node")
    more = (pieces.repartition("band", "chunk").sortWithinPartitions("band", "chunk", "side")
            .select("band", "chunk", "side", "node", "n_chars", "fingerprint").mapInArrow(run, "a long, b long"))
    return found.union(more).distinct()


def alike_pairs(pairs: DataFrame, nodes: DataFrame, alike: float) -> DataFrame:
    """The pairs (a, b) of nodes whose likeness is verified."""
    def verified(batches):
        embedder = Embedder()
        for batch in batches:
            a, b, f, g = (c.to_pylist() for c in batch.columns)
            good = [embedder.likeness(x["fingerprint"], x["n_chars"], y["fingerprint"], y["n_chars"]) >= alike
                    for x, y in zip(f, g)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]) \
                .filter(pa.array(good, pa.bool_()))

    one = nodes.select("node", F.struct("n_chars", "fingerprint").alias("f"))
    return materialise(pairs.join(one.select(F.col("node").alias("a"), F.col("f").alias("fa")), "a")
                       .join(one.select(F.col("node").alias("b"), F.col("f").alias("fb")), "b")
                       .select("a", "b", "fa", "fb").mapInArrow(verified, "a long, b long"))


def near_groups(prints: DataFrame, alike: float = ALIKE, group: int = GROUP) -> DataFrame:
    """doc_id and near_group, the smallest doc_id reachable over verified pairs."""
    spark = prints.sparkSession
    rows = prints.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_chars", "fingerprint",
                         F.xxhash64("n_chars", "fingerprint").alias("node"))
    nodes = materialise(rows.groupBy("node").agg(
        F.min("doc_id").alias("first_doc"), F.min(F.struct("n_chars", "fingerprint")).alias("f"))
        .select("node", "first_doc", "f.*"))
    members = materialise(rows.select("doc_id", "node").distinct())
    several = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1")
    same_id = members.join(several, "doc_id").filter("a <> node").select("a", F.col("node").alias("b"))

    live = materialise(meeting(banded(nodes), group))
    release(spark)                             # here and below: shuffles that are over
    links = materialise(same_id.union(small_band_links(live.filter("NOT large"), nodes, alike)))
    release(spark)
    large = live.filter("large").select("band", "node")
    if not large.isEmpty():
        links = materialise(links.union(large_band_links(large, nodes, links, alike, group)))
        release(spark)
    linked = materialise(nodes.select("node", "first_doc").join(connected_components(links), "node"))
    smallest = materialise(linked.groupBy("component").agg(F.min("first_doc").alias("near_group")))
    release(spark)
    grouped = linked.join(smallest, "component").select("node", "near_group")
    by_node = materialise(nodes.select("node", "first_doc").join(grouped, "node", "left").select(
        "node", F.coalesce("near_group", "first_doc").alias("near_group")))
    return unkeyed(members.join(by_node, "node").select("doc_id", "near_group").distinct())


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = materialise(fingerprint(read_table(spark, sf_dir, "documents")))
    release(spark)                             # the shuffled texts
    groups = near_groups(prints).withColumnRenamed("doc_id", "member")
    return prints.join(groups, F.col("doc_id").eqNullSafe(F.col("member")), "left").drop("member")


QUERIES = {"op3_fingerprints": op3_fingerprints}

"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

A text is walked once per repetition: at every step the walk writes the character
it stands on, and a shared random bit for (step, character) says whether it moves
on. Two texts at a small edit distance fall into step again after each edit, so
their walks differ in few places (Hamming distance). A repetition samples a few
places of the walk; a window and an item whose samples agree in any repetition are
a candidate, and the repetitions are as many as the target recall needs at the
greatest distance looked for. Candidates are verified by the exact edit distance
of the item to the best substring around the window.

Windows have the item's size and are laid where enough of the item's byte q-grams
stand on neighbouring diagonals. A long item is sought by long q-grams, with fewer
asked for than random edits of the greatest distance leave; an item of under
``EXACT_BYTES`` bytes by short ones, with as many as no edits within the distance can
break, whatever its script or number of words. Item and window are walked from a
shared q-gram. Texts are compared lower-cased (A-Z), with runs of ASCII punctuation
and white space as one space.

It is a map over whole texts: no shuffle. The benchmark is the query set: it is
broadcast in blocks of about ``BLOCK_BYTES``, one pass over the documents each.

Defined cases: null or empty texts and items (or such of separators only) match
nothing; an item so short that its distance allows no edit is found where it stands,
inside of words too; a text of any length is searched whole; of places at the same
distance the first is reported; repeated rows are reported each; tables
without rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchfold.llm.cgk import walk_steps
from watchfold.llm.common import PUNCTUATION, Rolling, doc_groups, mix64, read_table, text_buffer

MAX_DISTANCE = 0.2               # edits per character of the item
TARGET_RECALL = 0.98
SAMPLED = 3                      # places of the walk in one repetition
AGREEING = 0.4                   # share of places that agree at the greatest distance
WALKS = 4                        # the repetitions draw their places from so many walks
SEEDS_TRIED = 4                  # q-grams of a window from which it is walked
EXACT_BYTES = 50                 # items under this length are sought without loss
GRAMS = [(50, 6, 10), (80, 7, 10), (150, 8, 12)]   # from this length on: bytes of a q-gram, item's bytes per one asked for
EARLY = 1.0                      # places lie within so many steps per character
MIN_WALK = 12                    # characters; a shorter rest is verified at once
BLOCK_BYTES = 32_000_000
PERIOD = 1024                    # of the random bits along a walk
FILTER_BITS = 20
RESULT = "doc_id long, item_id long, start_byte long, n_bytes long, distance int, similarity double"


def repetitions(target: float = TARGET_RECALL, agreeing: float = AGREEING, sampled: int = SAMPLED) -> int:
    """Repetitions after which a pair with that share of agreeing places was met."""
    return math.ceil(math.log(1 - target) / math.log(1 - agreeing ** sampled))


def embed(text: bytes, steps: list[bytes], size: int) -> np.ndarray:
    """The characters on which the walk stands in its first ``size`` steps; 0 after its end."""
    moves, step, mask = [], 0, PERIOD - 1
    for c in text:
        moves.append(move := steps[c][step & mask])
        step += move
        if step >= size:
            break
    out = np.repeat(np.frombuffer(text[:len(moves)], np.uint8), moves)[:size]
    return np.concatenate([out, np.zeros(size - len(out), np.uint8)])


def normal(text: bytes) -> bytes:
    return re.sub(rb"[^0-9A-Za-z\x80-\xff]+", b" ", text).lower().strip()


def best_substring(item: bytes, text: bytes) -> tuple[int, int]:
    """(edit distance of ``item`` to its best substring of ``text``, end of that substring);
    bit-parallel dynamic programming over the rows of one column."""
    n = len(item)
    if not n:
        return 0, 0
    where: dict[int, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best = full, 0, n, (n, 0)
    for j, c in enumerate(text):
        same = where.get(c, 0)
        diagonal = ((((same & up) + up) ^ up) | same | down) & full
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & full, minus << 1 & full
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if score < best[0]:
            best = (score, j + 1)
    return best


def gram_of(n: int, allowed: int) -> tuple[int, int]:
    """Bytes of the q-grams by which an item of ``n`` bytes is sought, and how many are asked for."""
    if n < EXACT_BYTES:
        q = n // (allowed + 1)                   # an edit breaks q of the n - q + 1 at most
        return q, max(1, n - q + 1 - allowed * q)
    _, q, per = max(g for g in GRAMS if g[0] <= n)
    return q, n // per


class Items:
    """The benchmark's items of one block with their q-grams."""

    def __init__(self, rows: list[tuple[int, str]], max_distance: float):
        self.rows, grams = [], {}
        rolling = Rolling()
        for item_id, text in rows:
            text = normal((text or "").encode())
            if not text:
                continue
            allowed = int(len(text) * max_distance)
            q, asked = gram_of(len(text), allowed)
            rolling.load(np.frombuffer(text, np.uint8))
            hashes = rolling.windows(q)
            grams.setdefault(q, []).append((hashes, np.full(len(hashes), len(self.rows)), np.arange(len(hashes))))
            self.rows.append((item_id, text, q, asked, allowed))
        self.grams = {}                          # q: (hashes in order, items, places, filter)
        for q, parts in sorted(grams.items()):
            hashes, item, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(hashes, kind="stable")
            known = np.zeros(1 << FILTER_BITS, bool)
            known[hashes >> np.uint64(64 - FILTER_BITS)] = True
            self.grams[q] = hashes[order], item[order], at[order], known
        self.longest = max((len(r[1]) for r in self.rows), default=0)
        self.asked, self.allowed = (np.array([r[c] for r in self.rows], np.int64) for c in (3, 4))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER[PUNCTUATION] = 32


def normal_group(data: np.ndarray, offsets: np.ndarray):
    """(normalised bytes, place of each in ``data``, offsets of the rows) of a group of texts;
    a row may end in a space."""
    inside = ~PUNCTUATION[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]                      # the first separator of a run
    starts = offsets[:-1][np.diff(offsets) > 0]
    keep[starts] = inside[starts]
    places = np.flatnonzero(keep)
    return LOWER[data[places]], places, np.searchsorted(places, offsets)


class Searcher:
    """Finds items in a group of texts."""

    def __init__(self, items: Items):
        self.items, self.rolling = items, Rolling()
        self.steps = [walk_steps(r, PERIOD) for r in range(WALKS)]
        draws = mix64(np.arange(WALKS * -(-repetitions() // WALKS) * SAMPLED, dtype=np.uint64) + np.uint64(99))
        self.draws = (draws >> np.uint64(11)).astype(np.float64).reshape(WALKS, -1, SAMPLED) / 2**53
        self.embedded: dict[tuple[int, int, int], np.ndarray] = {}

    def near(self, k: int, at: int, data: np.ndarray, place: int, lo: int, hi: int) -> bool:
        """Whether item and window agree in the sampled places of any repetition. Both are
        walked from the q-gram (at ``at`` of the item, ``place`` of the text) to the farther end."""
        _, text, q, _, _ = self.items.rows[k]
        forward = len(text) - at - q >= at
        size = len(text) - at - q if forward else at
        if size < MIN_WALK:
            return True
        window = (data[place + q:min(hi, place + q + size)] if forward
                  else data[max(lo, place - size):place][::-1]).tobytes()
        steps = int(EARLY * size)
        for r in range(WALKS):
            known = self.embedded.get((k, at, r))
            if known is None:
                side = text[at + q:] if forward else text[:at][::-1]
                known = self.embedded[k, at, r] = embed(side, self.steps[r], steps)
            same = embed(window, self.steps[r], steps) == known
            if same[(self.draws[r] * steps).astype(np.int64)].all(1).any():
                return True
        return False

    def windows(self, data: np.ndarray, offsets: np.ndarray):
        """Neighbourhoods with enough q-grams of an item: (row, item, places in the text,
        places in the item)."""
        items, found = self.items, []
        self.rolling.load(data)
        for q, (hashes, item, at, known) in items.grams.items():
            h = self.rolling.windows(q)
            hit = np.flatnonzero(known[h >> np.uint64(64 - FILTER_BITS)])
            low = np.searchsorted(hashes, h[hit], "left")
            n = np.searchsorted(hashes, h[hit], "right") - low
            hit, low, n = hit[n > 0], low[n > 0], n[n > 0]
            row = np.searchsorted(offsets, hit, "right") - 1
            whole = hit + q <= offsets[row + 1]
            hit, low, n, row = hit[whole], low[whole], n[whole], row[whole]
            gram = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            found.append((np.repeat(row, n), item[gram], np.repeat(hit, n), at[gram]))
        if not found:
            return
        row, item, place, at = (np.concatenate(x) for x in zip(*found))
        room = len(data) + items.longest         # twice that: the diagonals of one row and item
        key = (row * len(items.rows) + item) * (2 * room) + (place - at + room)
        order = np.argsort(key, kind="stable")
        key, row, item, place, at = key[order], row[order], item[order], place[order], at[order]
        ends = np.searchsorted(key, key + items.allowed[item], "right")
        good = np.flatnonzero(ends - np.arange(len(key)) >= items.asked[item])
        if not len(good):
            return
        new = np.ones(len(good), bool)
        new[1:] = key[good[1:]] - key[good[:-1]] > items.allowed[item[good[1:]]]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(good)) - 1
        for a, b in zip(good[first].tolist(), ends[good[last]].tolist()):
            yield int(row[a]), int(item[a]), place[a:b], at[a:b]

    def search(self, data: np.ndarray, offsets: np.ndarray):
        """(row, item_id, start, length, distance, similarity), the best place of each pair."""
        self.embedded.clear()                    # walks of items are kept for one group of texts
        data, places, bounds = normal_group(data, offsets)
        best: dict[tuple[int, int], tuple] = {}
        for row, k, place, at in self.windows(data, bounds):
            _, text, _, _, allowed = self.items.rows[k]
            lo, hi = bounds[row], bounds[row + 1]
            tried = np.unique(np.linspace(0, len(at) - 1, SEEDS_TRIED).astype(np.int64)).tolist()
            if not any(self.near(k, int(at[t]), data, int(place[t]), lo, hi) for t in tried):
                continue
            shift = place - at
            a = max(lo, int(shift.min()) - allowed)
            b = min(hi, int(shift.max()) + len(text) + allowed)
            distance, end = best_substring(text, data[a:b].tobytes())
            if distance <= allowed and distance < best.get((row, k), (len(text) + 1,))[0]:
                best[row, k] = (distance, a, a + end)
        for (row, k), (distance, a, end) in sorted(best.items()):
            item_id, text, _, _, _ = self.items.rows[k]
            length = best_substring(text[::-1], data[a:end][::-1].tobytes())[1]
            start = int(places[end - length])
            yield (row, item_id, start - int(offsets[row]), int(places[end - 1]) + 1 - start, distance,
                   1 - distance / len(text))


def item_blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The distinct items, dealt by hash into blocks of about ``BLOCK_BYTES``."""
    items = benchmark.select("item_id", "text").distinct()
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return [items.filter(number == k) for k in range(blocks)]


def items_of(block: DataFrame) -> list[tuple[int, str]]:
    return [(r.item_id, r.text) for r in block.orderBy("item_id", "text").collect()]


def find(docs: DataFrame, benchmark: DataFrame, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """One row per document and item found in it: its best place, distance and similarity."""
    out = None
    for block in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items_of(block))

        def run(batches, shared=shared):
            searcher = None
            for batch in batches:
                searcher = searcher or Searcher(Items(shared.value, max_distance))
                data, offsets = text_buffer(batch.column(1))
                ids, found = batch.column(0), []
                for lo, hi in doc_groups(offsets):
                    own = offsets[lo:hi + 1] - offsets[lo]
                    found += [(lo + r[0], *r[1:]) for r in searcher.search(data[offsets[lo]:offsets[hi]], own)]
                columns = list(zip(*found)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(columns[0], pa.int64())).cast(pa.int64()),
                     *(pa.array(c, t) for c, t in zip(columns[1:], kinds))],
                    names=["doc_id", "item_id", "start_byte", "n_bytes", "distance", "similarity"])

        found = docs.select("doc_id", "text").mapInArrow(run, RESULT)
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, max_distance: float = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` in whose texts no item is found; a map, without a shuffle."""
    for block in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items_of(block))

        def run(batches, shared=shared):
            searcher = None
            for batch in batches:
                searcher = searcher or Searcher(Items(shared.value, max_distance))
                data, offsets = text_buffer(batch.column(batch.schema.names.index("text")))
                keep = np.ones(batch.num_rows, bool)
                for lo, hi in doc_groups(offsets):
                    own = offsets[lo:hi + 1] - offsets[lo]
                    keep[[lo + r[0] for r in searcher.search(data[offsets[lo]:offsets[hi]], own)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {"op9_decontamination": op9_decontamination}

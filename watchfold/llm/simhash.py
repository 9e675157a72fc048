"""SimHash near-dedup with deletion-variant signatures.

A text is lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and hashed by 3-word
shingles, repeats included (XXH64 of the space-joined UTF-8 bytes, seed 42). A
bit of the 64-bit fingerprint is 1 if it is set in over half of the hashes. Two
fingerprints link when they differ in at most ``DISTANCE`` = 3 bits.

Four segments would be needed for one of them to be equal. Here the 64 bits are cut
into two only, so one of them differs by at most one bit: each half is indexed
under its 32 one-wildcard variants (the half with one bit deleted), and two halves
that differ by at most one bit share a variant. Distinct fingerprints only are
indexed (copies are one node), variants meet in an equality shuffle, and every
pair that meets is verified inside the task, which passes on no more than a spanning
forest of what it has verified.

Rows of a variant arrive sorted and are worked on as a stream. A variant that more than
``GROUP`` fingerprints share is cut up further, not compared pair by pair: within it
the other half differs by at most three bits, so its two quarters are indexed by
one-wildcard variants too, and their halves once more. Three levels leave eight bits
and three wildcards free, so at most 2**11 fingerprints can share such a variant:
no group is ever larger than ``GROUP``, whatever the data, and no link is lost.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is
linked like any other; a text of one or two words is one shingle; a text may be of any
length (its hashes are counted 50,000 at a time); repeated rows and ids
are returned each time; equal fingerprints are linked whatever their ids; a null
doc_id is kept and is never the id of a component unless all its ids are null; a table
without rows gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchfold.llm.common import materialise, read_table, text_buffer
from watchfold.llm.components import connected_components

DISTANCE = 3
SHINGLE = 3
SEED = 42
HASHES = 50_000                  # of one text held at a time
GROUP = 4_096                    # fingerprints of a variant that are compared in one go; 2**11 at least
BLOCK = 512                      # of them against all others in one numpy operation
WIDTHS = (32, 16, 8)             # bits of the segments of each level


# --- fingerprints ----------------------------------------------------------------

def fingerprint(text: bytes) -> int:
    """The unsigned fingerprint of a UTF-8 text."""
    words = text.lower().split()             # bytes: only A-Z and the six ASCII white spaces
    if not words:
        return 0
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.append(gaps, len(joined))
    count = max(1, len(words) - SHINGLE + 1)
    starts, ends = starts[:count], ends[-count:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for lo in range(0, count, HASHES):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[lo:lo + HASHES].tolist(), ends[lo:lo + HASHES].tolist())], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        raw, at = memoryview(np.ascontiguousarray(data)), offsets.tolist()
        found = np.fromiter((fingerprint(bytes(raw[a:b])) for a, b in zip(at, at[1:])), np.uint64, len(at) - 1)
        yield pa.record_batch([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprint_rows, f"doc_id {kind}, fp bigint")


# --- variants --------------------------------------------------------------------

def free_segment(path: int, level: int) -> tuple[int, int]:
    """(first bit, width) that the ``level`` variants of ``path`` have not looked at yet."""
    low, width = 0, 64
    for at in range(level):
        width = WIDTHS[at]
        segment = _choice(path, at) // width
        low += 0 if segment else width           # the other segment stays free
    return low, width


def _choice(path: int, level: int) -> int:
    """Segment and deleted bit of ``path`` at a level, as ``segment * width + bit``."""
    for width in WIDTHS[:level]:
        path //= 2 * width
    return path % (2 * WIDTHS[level])


def variants(fps: np.ndarray, level: int, path: int = 0, value: int = 0):
    """(path, value, fp) of all one-wildcard variants of the free segment's two halves.

    ``path`` names the segments and deleted bits chosen so far; ``value`` holds the bits
    kept by them, which all of ``fps`` share. The result has the new ones added.
    """
    low, _ = free_segment(path, level)
    width = WIDTHS[level]
    scale = int(np.prod([2 * w for w in WIDTHS[:level]], dtype=np.int64))
    paths, values = [], []
    for choice in range(2 * width):
        segment, bit = divmod(choice, width)
        base = low + segment * width
        keep = (((1 << width) - 1) ^ (1 << bit)) << base
        values.append((fps & np.uint64(keep)) | np.uint64(value))
        paths.append(np.full(len(fps), path + choice * scale, np.int32))
    return np.concatenate(paths), np.concatenate(values), np.tile(fps, 2 * width)


VARIANT = "path int, value bigint, fp bigint"


def _first_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(lo, 2_000) for lo in range(0, batch.num_rows, 2_000)):
            yield _variant_batch(*variants(_bits(part.column("fp")), 0))


def _next_variants(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, value, fps = (batch.column("path").to_numpy(), _bits(batch.column("value")),
                                _bits(batch.column("fp")))
            order = np.lexsort((value, path))
            path, value, fps = path[order], value[order], fps[order]
            edges = np.flatnonzero(np.append(True, (path[1:] != path[:-1]) | (value[1:] != value[:-1])))
            for lo, hi in zip(edges.tolist(), np.append(edges[1:], len(path)).tolist()):
                for at in range(lo, hi, 2_000):
                    yield _variant_batch(*variants(fps[at:min(hi, at + 2_000)], level, int(path[lo]), int(value[lo])))
    return run


def _bits(column: pa.Array) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False), np.int64).view(np.uint64)


def _variant_batch(path, value, fps) -> pa.RecordBatch:
    return pa.record_batch([pa.array(path), pa.array(value.view(np.int64)), pa.array(fps.view(np.int64))],
                           ["path", "value", "fp"])


# --- links of one variant's fingerprints -----------------------------------------

def forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all of ``fps`` (distinct) that are connected by links of at most
    ``DISTANCE`` bits among them: each reached one with the one it was reached from."""
    n = len(fps)
    parent, waiting = np.full(n, -1), np.ones(n, bool)
    while waiting.any():
        seed = int(np.argmax(waiting))
        waiting[seed] = False
        border = np.array([seed])
        while len(border):
            reached = []
            for lo in range(0, len(border), BLOCK):
                rest = np.flatnonzero(waiting)
                if not len(rest):
                    break
                own = border[lo:lo + BLOCK]
                near = np.bitwise_count(fps[own][:, None] ^ fps[rest][None, :]) <= DISTANCE
                hit = near.any(0)
                parent[rest[hit]] = own[near[:, hit].argmax(0)]
                waiting[rest[hit]] = False
                reached.append(rest[hit])
            border = np.concatenate(reached) if reached else np.zeros(0, np.int64)
    linked = np.flatnonzero(parent >= 0)
    return fps[linked], fps[parent[linked]]


OUT = "path int, value bigint, fp bigint, other bigint"


def _verified(limit: int):
    """Streams rows sorted by (path, value): links of each variant, or, of a variant with more
    than ``limit`` rows, its rows as they are (without ``other``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, value, fps = np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        large = None                             # the variant that is being passed on
        for batch in batches:
            path = np.concatenate([path, batch.column("path").to_numpy()])
            value = np.concatenate([value, _bits(batch.column("value"))])
            fps = np.concatenate([fps, _bits(batch.column("fp"))])
            starts = np.flatnonzero(np.append(True, (path[1:] != path[:-1]) | (value[1:] != value[:-1])))
            last = int(starts[-1])
            key = (int(path[last]), int(value[last]))
            ends = np.append(starts[1:], len(path))
            open_run = len(path) - last > limit or large == key
            done = len(starts) if open_run else len(starts) - 1
            out, large = _work(path, value, fps, starts[:done], ends[:done], limit, large)
            large = key if open_run else None
            if out is not None:
                yield out
            keep = len(path) if open_run else last
            path, value, fps = path[keep:], value[keep:], fps[keep:]
        if len(path):
            out, _ = _work(path, value, fps, np.array([0]), np.array([len(path)]), limit, large)
            if out is not None:
                yield out
    return run


def _work(path, value, fps, starts, ends, limit, large):
    """The rows to pass on of closed variants, and of open ones that are too large."""
    sizes = ends - starts
    two = starts[sizes == 2]                     # most are: one comparison each
    if len(two) and large == (int(path[two[0]]), int(value[two[0]])):
        two = two[1:]
    two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= DISTANCE]
    a, b, whole = [fps[two]], [fps[two + 1]], []
    for k in np.flatnonzero((sizes > 2) | (np.arange(len(starts)) == 0)).tolist():
        lo, hi = int(starts[k]), int(ends[k])
        if hi - lo > limit or large == (int(path[lo]), int(value[lo])):
            whole.append(np.arange(lo, hi))
        elif hi - lo > 2:
            x, y = forest(fps[lo:hi])
            a.append(x)
            b.append(y)
    columns = []
    if sum(map(len, a)):
        a, b = np.concatenate(a), np.concatenate(b)
        nothing = np.zeros(len(a), np.int64)
        columns.append((np.zeros(len(a), np.int32), nothing, a.view(np.int64), pa.array(b.view(np.int64))))
    if whole:
        w = np.concatenate(whole)
        columns.append((path[w], value[w].view(np.int64), fps[w].view(np.int64), pa.nulls(len(w), pa.int64())))
    if not columns:
        return None, large
    batches = [pa.record_batch([pa.array(p), pa.array(v), pa.array(f), o], ["path", "value", "fp", "other"])
               for p, v, f, o in columns]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0], large


def links(nodes: DataFrame, group: int = GROUP) -> DataFrame:
    """(fp, other): links that connect every two linked fingerprints of ``nodes`` (fp, distinct),
    be it by a chain. ``group`` may be lowered for tests; the last level has no limit."""
    rows, found = nodes.select("fp").mapInArrow(_first_variants, VARIANT), None
    for level in range(len(WIDTHS)):
        last = level == len(WIDTHS) - 1
        limit = max(group, 1 << 11) if last else group
        sorted_rows = rows.repartition("path", "value").sortWithinPartitions("path", "value")
        out = materialise(sorted_rows.mapInArrow(_verified(limit), OUT))
        pairs = out.filter("other IS NOT NULL").select("fp", "other")
        found = pairs if found is None else found.unionAll(pairs)
        large = out.filter("other IS NULL").select("path", "value", "fp")
        if last or large.isEmpty():
            return found
        rows = large.mapInArrow(_next_variants(level + 1), VARIANT)


def near_duplicates(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable by links) of every row."""
    found = materialise(fingerprints(docs))
    nodes = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("first")))
    labels = connected_components(links(nodes, group), "fp", "other").withColumnRenamed("node", "fp")
    linked = materialise(nodes.join(labels, "fp"))
    firsts = materialise(linked.groupBy("component").agg(F.min("first").alias("component_id")))
    linked = linked.join(firsts, "component").select("fp", "component_id")
    # written, so that the last join has plain inputs and a hot fingerprint's rows can be split
    named = materialise(nodes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first")
                                                                .alias("component_id")))
    return found.join(named, "fp").select("doc_id", "fp", "component_id")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op13_simhash": op13_simhash}

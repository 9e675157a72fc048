"""First occurrences of long windows over a whole corpus, exactly and in linear space.

A document is a sequence of elements (bytes or words), a window is ``width``
consecutive elements of one document. Wanted are the windows whose content also
starts earlier (smaller doc_id, or earlier in the same document). Emitting every
window would move many times the corpus, so windows travel in runs:

1. Every window gets an anchor: of the positions inside it, the one of least
   priority. A priority depends only on elements inside the window, so equal
   windows have equal anchors at equal offsets. Neighbouring windows with one
   anchor form a run, which is one record: the hash of the anchor's elements,
   and the hash of all elements of the run.
2. Records meet by anchor. Of equal runs all but the first are repeats as a whole.
   First runs are over, too, if no other content surrounds their anchor; the rest
   is open: parts of them may repeat.
3. Open runs meet by anchor once more, with their elements: as the hash of each window,
   or, for bytes, as they are, to be sorted as suffixes (``Windows.compare``).

A record carries 128 bits of hash, a hashed window of an open run 64 bits besides its
anchor. Records travel in blocks, one row per batch and bucket. Equal
ones of a batch are reduced to the first before they travel, so copies, however
many, are few records. Anchors that are frequent in a sample of the documents
(a line or passage that very many share) are dealt out by content, not by anchor;
windows of open runs whose anchor has many contents likewise. Texts are shuffled
once, by ``doc_id``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from watchfold.llm.common import (
    Rolling,
    bucket_slices,
    doc_groups,
    materialise,
    mix64,
    run_starts,
    shuffle_parts,
    text_buffer,
)

SEGMENT = 4_000_000              # elements of one document handled at a time
PLACE_BITS = 23
NO_ID = -(1 << 63)               # stands for a null doc_id, before all others
HOT_SHARE = 1 / 500              # of sampled documents, beyond which an anchor is dealt by content
HOT_MAX = 200_000                # bound of the broadcast list of such anchors
HOT_SAMPLE = 10_000              # documents in the sample that finds them
OPEN_HOT = 256                   # contents of one anchor, beyond which its windows are dealt singly
BYTES_PER_TASK = 6_000_000
DONE, OPEN, OPEN_SINGLY = 0, 1, 2
SPANS = "bucket int, doc binary, lo binary, n binary, at binary, mode binary, anchor binary"
MET = "bucket int, doc binary, lo binary, n binary, at binary, mode binary, payload binary"
HASH_BYTES = 8


@dataclass(frozen=True)
class Windows:
    """What a window is and how its anchor is chosen."""

    width: int
    gram: int                                       # elements that name an anchor
    left: int                                       # elements before it that its priority reads
    elements: Callable                              # () -> f(data, offsets) -> (values, bounds)
    priority: Callable | None = None                # f(values, grams) -> priority of each position
    # How open runs compare by their bytes: f(doc, lo, n, at, context, width) -> one flag per
    # window, in order of runs and places; without it their windows compare by hash.
    compare: Callable | None = None


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive numbers (block prefix and suffix minima)."""
    n = len(a)
    padded = np.full(-(-n // width) * width, np.iinfo(a.dtype).max, a.dtype)
    padded[:n] = a
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


class RunFinder:
    """Runs of a group of rows: (anchor, content, row, first window, windows, anchor's place
    in the first window)."""

    def __init__(self, spec: Windows):
        self.spec, self.rolling = spec, Rolling(seed=11)

    def __call__(self, values: np.ndarray, bounds: np.ndarray):
        w, found = self.spec.width, []
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        for at in range(0, max(1, len(values) - w + 1), SEGMENT):
            part = slice(at, at + SEGMENT + w - 1)
            found.append(self._segment(values[part], owner[part], at))
        out = [np.concatenate(x) for x in zip(*found)]
        out[3] = out[3] - bounds[out[2]]
        return out

    def _segment(self, values, owner, offset):
        spec, n = self.spec, len(values)
        if n < spec.width:
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), none, none, none, none
        self.rolling.load_values(values)
        grams = mix64(self.rolling.windows(spec.gram))
        rank = grams if spec.priority is None else spec.priority(values, grams)
        places = np.uint64((1 << PLACE_BITS) - 1)
        ranked = (rank & ~places) | np.arange(len(rank), dtype=np.uint64)
        choices = spec.width - spec.gram - spec.left + 1
        anchor = (sliding_min(ranked[spec.left:], choices) & places).astype(np.int64)
        start = np.flatnonzero(owner[:n - spec.width + 1] == owner[spec.width - 1:])
        if not len(start):
            return self._segment(values[:0], owner[:0], offset)
        anchor = anchor[start]
        first = run_starts(anchor, start - np.arange(len(start)), owner[start])
        lo, at = start[first], anchor[first]
        count = np.diff(np.append(np.flatnonzero(first), len(start)))
        content = self.rolling.of(lo, lo + count - 1 + spec.width)
        content = mix64(content + (at - lo).astype(np.uint64) * np.uint64(0x9E37)
                        + count.astype(np.uint64) * np.uint64(0x79B97F4A7C15F39C))
        return grams[at], content, owner[lo], lo + offset, count, at - lo


def doc_bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return np.mod(doc ^ (doc >> 17), buckets)


def doc_bucket_column(column, buckets: int):
    return F.pmod(column.bitwiseXOR(F.shiftright(column, 17)), F.lit(buckets)).cast("int")


def _pack(columns: dict[str, np.ndarray], buckets: np.ndarray, n: int):
    """Rows of blocks: one per bucket that has records, a few hundred buckets at a time."""
    order, cut = bucket_slices(buckets, n)
    columns = {k: v[order] for k, v in columns.items()}
    full = np.flatnonzero(np.diff(cut))
    for part in np.array_split(full, max(1, len(full) // 256)):
        if len(part):
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(part, pa.int32())} | {
                k: pa.array([v[cut[b]:cut[b + 1]].tobytes() for b in part], pa.binary())
                for k, v in columns.items()})


TYPES = {"doc": np.int64, "lo": np.int32, "n": np.int32, "at": np.int16, "mode": np.int8,
         "anchor": np.uint64, "content": np.uint64, "payload": np.uint8}


def _unpack(batches, names) -> dict[str, np.ndarray]:
    parts: dict[str, list] = {k: [] for k in names}
    for batch in batches:
        for k in names:
            parts[k] += [np.frombuffer(x.as_buffer(), TYPES[k]) for x in batch.column(k) if x.is_valid]
    return {k: np.concatenate(v) if v else np.zeros(0, TYPES[k]) for k, v in parts.items()}


def _later(doc, lo, *same):
    """Sort order by content, document and place; True where the content also starts earlier."""
    order = np.lexsort((lo, doc, *same[::-1]))
    doc, lo, same = doc[order], lo[order], [c[order] for c in same]
    first = run_starts(*same)
    head = np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
    return order, first, (doc != doc[head]) | (lo != lo[head])


def _runs_of_batch(batch, spec, elements, finder):
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
    data, offsets = text_buffer(batch.column("text"))
    parts = []
    for a, b in doc_groups(offsets):
        values, bounds = elements(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        anchor, content, row, lo, n, at = finder(values, bounds)
        parts.append((anchor, content, ids[a:b][row], lo.astype(np.int32), n.astype(np.int32), at.astype(np.int16)))
    if not parts:
        return [np.zeros(0, TYPES[k]) for k in ("anchor", "content", "doc", "lo", "n", "at")]
    return [np.concatenate(x) for x in zip(*parts)]


def hot_anchors(docs: DataFrame, spec: Windows, rows: int) -> np.ndarray:
    """Anchors that a large share of a sample of documents has, with different surroundings."""
    share = min(1.0, HOT_SAMPLE / max(rows, 1))
    least = max(8, int(min(rows, HOT_SAMPLE) * HOT_SHARE))
    sample = docs.filter(F.pmod(F.xxhash64(F.lit("hot"), "doc_id"), F.lit(1_000_000)) < share * 1e6)

    def count(batches):
        elements, finder = spec.elements(), RunFinder(spec)
        for batch in batches:
            anchor, content, *_ = _runs_of_batch(batch, spec, elements, finder)
            pairs = np.unique(np.stack([anchor, content]), axis=1)[0] if len(anchor) else anchor
            anchor, n = np.unique(pairs, return_counts=True)
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(anchor.view(np.int64)),
                                              "n": pa.array(n.astype(np.int64))})

    top = (sample.select("doc_id", "text").mapInArrow(count, "anchor long, n long")
           .groupBy("anchor").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
           .orderBy(F.desc("n"), "anchor").limit(HOT_MAX))
    return np.sort(top.select("anchor").toPandas()["anchor"].to_numpy(np.int64).view(np.uint64))


def _is_in(values: np.ndarray, sorted_list: np.ndarray) -> np.ndarray:
    if not len(sorted_list):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_list, values), len(sorted_list) - 1)
    return sorted_list[at] == values


def _flagged_runs(doc, pos, flag):
    """Flagged windows, in order of document and place, as (doc, lo, n)."""
    at = np.flatnonzero(flag)
    if not len(at):
        return doc[:0], pos[:0], pos[:0]
    start = run_starts(doc[at], pos[at] - np.arange(len(at)))
    n = np.diff(np.append(np.flatnonzero(start), len(at)))
    return doc[at][start], pos[at][start], n.astype(np.int32)


def repeated_windows(docs: DataFrame, spec: Windows) -> tuple[DataFrame, DataFrame, int]:
    """(texts by bucket, blocks of repeated runs by bucket, buckets) for :func:`covered`.

    ``docs`` has doc_id (no nulls, see :func:`keyed`), text and whatever is to be carried along.
    """
    spark = docs.sparkSession
    size, rows = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    parts = max(shuffle_parts(spark), -(-size // BYTES_PER_TASK))
    buckets = 4 * parts + 1                         # of documents; records go to ``parts``
    hot = spark.sparkContext.broadcast(hot_anchors(docs, spec, rows))
    record = ("doc", "lo", "n", "at", "anchor", "content")
    sent_schema = "bucket int, " + ", ".join(f"{k} binary" for k in (*record, "mode"))

    def send(batches):
        elements, finder = spec.elements(), RunFinder(spec)
        for batch in batches:
            anchor, content, doc, lo, n, at = _runs_of_batch(batch, spec, elements, finder)
            order, first, later = _later(doc, lo, anchor, content)
            anchor, content, doc, lo, n, at = (x[order] for x in (anchor, content, doc, lo, n, at))
            kept = first | later            # a repeated row of the table is neither
            by = np.where(_is_in(anchor, hot.value), mix64(anchor + content), anchor)
            done = np.where(later, DONE, OPEN).astype(np.int8)
            yield from _pack({"doc": doc[kept], "lo": lo[kept], "n": n[kept], "at": at[kept],
                              "anchor": anchor[kept], "content": content[kept], "mode": done[kept]},
                             (by[kept] % np.uint64(parts)).astype(np.int64), parts)

    def meet(batches):
        r = _unpack(batches, (*record, "mode"))
        over = r["mode"] == DONE
        live = {k: v[~over] for k, v in r.items()}
        order, first, later = _later(live["doc"], live["lo"], live["anchor"], live["content"])
        live = {k: v[order] for k, v in live.items()}
        groups = run_starts(live["anchor"])
        group = np.cumsum(groups) - 1
        contents = np.bincount(group, weights=first).astype(np.int64) if len(group) else group
        hot_one = _is_in(live["anchor"], hot.value)
        several = hot_one | (contents[group] > 1)
        singly = hot_one | (contents[group] > OPEN_HOT)
        mode = np.where(later, DONE, np.where(singly, OPEN_SINGLY, OPEN)).astype(np.int8)
        kept = later | (first & several)
        live["mode"] = mode
        out = {k: np.concatenate([live[k][kept], r[k][over]]) for k in ("doc", "lo", "n", "at", "mode", "anchor")}
        yield from _pack(out, doc_bucket(out["doc"], buckets), buckets)

    blocks = (docs.select("doc_id", "text").mapInArrow(send, sent_schema)
              .repartitionById(parts, "bucket").mapInArrow(meet, SPANS))
    blocks = materialise(blocks)
    texts = docs.select(doc_bucket_column(F.col("doc_id"), buckets).alias("bucket"), *docs.columns)

    def open_runs(texts, blocks):
        """The open runs of one bucket of documents, with their elements."""
        r = _unpack(blocks.to_batches(), ("doc", "lo", "n", "at", "mode", "anchor"))
        open_ = r["mode"] != DONE
        order = np.lexsort((r["lo"][open_], r["doc"][open_]))
        r = {k: v[open_][order] for k, v in r.items()}
        elements, rolling = spec.elements(), Rolling(seed=13)
        found, seen = [], set()
        for doc, text in zip(texts.column("doc_id").to_pylist(), texts.column("text")):
            a, b = np.searchsorted(r["doc"], [doc, doc + 1])
            if a == b or doc in seen or not text.is_valid:
                continue
            seen.add(doc)
            data = np.frombuffer(text.as_buffer(), np.uint8)
            raw = (r["mode"][a:b] == OPEN) & (spec.compare is not None)
            values = data
            if not raw.all():
                values, _ = elements(data, np.array([0, len(data)]))
                rolling.load_values(values)
            for part, own in ((True, np.flatnonzero(raw)), (False, np.flatnonzero(~raw))):
                if not len(own):
                    continue
                lo = r["lo"][a:b][own]
                size = r["n"][a:b][own] + (spec.width - 1 if part else 0)
                pos = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
                if part:
                    found.append((a + own, size, data[np.minimum(pos, len(data) - 1)]))
                else:
                    pos = np.minimum(pos, len(values) - spec.width)
                    found.append((a + own, size, mix64(rolling.of(pos, pos + spec.width))))
        rows = []
        for kind, unit in ((np.uint8, 1), (np.uint64, HASH_BYTES)):
            chosen = [f for f in found if f[2].dtype == kind]
            if not chosen:
                continue
            run, size, payload = (np.concatenate(x) for x in zip(*chosen))
            single = r["mode"][run] == OPEN_SINGLY
            if single.any():
                rows += _single_windows(r, run, size, payload, single)
            rows += _whole_runs(r, run[~single], size[~single], (np.cumsum(size) - size)[~single], payload)
        if not rows:
            rows = [pa.RecordBatch.from_pydict({"bucket": pa.array([], pa.int32())} | {
                k: pa.array([], pa.binary()) for k in ("doc", "lo", "n", "at", "mode", "payload")})]
        return pa.Table.from_batches(rows)

    def _single_windows(r, run, size, hashes, single):
        """Blocks of windows dealt by their own hash, equal ones reduced to the first."""
        owner = np.repeat(np.arange(len(run)), size)
        place = r["lo"][run][owner] + (np.arange(len(owner)) - (np.cumsum(size) - size)[owner]).astype(np.int32)
        taken = single[owner]
        doc, pos, h = r["doc"][run][owner][taken], place[taken], hashes[taken]
        order, first, later = _later(doc, pos, h)
        doc, pos, h = doc[order], pos[order], h[order]
        n = int(first.sum())
        yield from _pack({"doc": doc[first], "lo": pos[first], "n": np.ones(n, np.int32),
                          "at": np.zeros(n, np.int16), "mode": np.full(n, OPEN_SINGLY, np.int8),
                          "payload": h[first]}, (h[first] % np.uint64(parts)).astype(np.int64), parts)
        order = np.lexsort((pos[later], doc[later]))
        doc, lo, count = _flagged_runs(doc[later][order], pos[later][order], np.ones(int(later.sum()), bool))
        yield from _pack({"doc": doc, "lo": lo, "n": count, "at": np.zeros(len(doc), np.int16),
                          "mode": np.full(len(doc), DONE, np.int8), "payload": np.zeros(len(doc), np.uint64)},
                         np.mod(doc_bucket(doc, buckets), parts), parts)

    def _whole_runs(r, run, size, start, payload):
        """Blocks of runs dealt by their anchor, with the payload of each."""
        order, cut = bucket_slices((r["anchor"][run] % np.uint64(parts)).astype(np.int64), parts)
        run, size, start = run[order], size[order], start[order]
        first = np.concatenate([[0], np.cumsum(size)])
        payload = payload[np.repeat(start - first[:-1], size) + np.arange(first[-1])]
        full = np.flatnonzero(np.diff(cut))
        block = lambda v: pa.array([v[cut[b]:cut[b + 1]].tobytes() for b in full], pa.binary())
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(full, pa.int32())} | {k: block(r[k][run]) for k in ("doc", "lo", "n", "at", "mode")}
            | {"payload": pa.array([payload[first[cut[b]]:first[cut[b + 1]]].tobytes() for b in full], pa.binary())})

    def compare(batches):
        """Windows of open runs that also start earlier, as runs."""
        r = _unpack(batches, ("doc", "lo", "n", "at", "mode", "payload"))
        mode, payload = r.pop("mode"), r.pop("payload")
        raw = (mode == OPEN) & (spec.compare is not None)
        size = np.where(raw, r["n"] + spec.width - 1, HASH_BYTES * np.where(mode == OPEN, r["n"], 1)).astype(np.int64)
        start = np.cumsum(size) - size
        out = [tuple(r[k][mode == DONE] for k in ("doc", "lo", "n"))]

        def taken(which):
            at = np.repeat(start[which] - (np.cumsum(size[which]) - size[which]), size[which])
            return payload[at + np.arange(len(at))]

        def windows_of(which):
            n = r["n"][which]
            doc = np.repeat(r["doc"][which], n)
            return doc, (np.repeat(r["lo"][which] - (np.cumsum(n) - n), n) + np.arange(n.sum())).astype(np.int32)

        hashed, direct = np.flatnonzero(~raw & (mode != DONE)), np.flatnonzero(raw)
        if len(hashed):
            doc, pos = windows_of(hashed)
            order, _, later = _later(doc, pos, taken(hashed).view(np.uint64))
            flag = np.zeros(len(doc), bool)
            flag[order[later]] = True
            out.append(_flagged_runs(doc, pos, flag))
        if len(direct):
            flag = spec.compare(*(r[k][direct] for k in ("doc", "lo", "n", "at")), taken(direct), spec.width)
            out.append(_flagged_runs(*windows_of(direct), flag))
        doc, lo, n = (np.concatenate(x) for x in zip(*out))
        yield from _pack({"doc": doc, "lo": lo, "n": n, "at": np.zeros(len(doc), np.int16),
                          "mode": np.zeros(len(doc), np.int8), "anchor": np.zeros(len(doc), np.uint64)},
                         doc_bucket(doc, buckets), buckets)

    met = texts.groupBy("bucket").cogroup(blocks.groupBy("bucket")).applyInArrow(open_runs, MET)
    found = met.repartitionById(parts, "bucket").mapInArrow(compare, SPANS)
    return texts, blocks.union(found), buckets


def covered(texts: DataFrame, blocks: DataFrame, spec: Windows, finish: Callable, schema: str) -> DataFrame:
    """Apply ``finish(doc_ids, texts, covered)`` to the documents of each bucket and add the
    columns that ``texts`` carries besides doc_id and text.

    ``covered(k, n)`` is a boolean array over the ``n`` elements of the k-th of them.
    """
    carried = [f for f in texts.schema.fields if f.name not in ("bucket", "doc_id", "text")]

    def run(texts, blocks):
        r = _unpack(blocks.to_batches(), ("doc", "lo", "n", "mode"))
        done = r["mode"] == DONE
        order = np.argsort(r["doc"][done], kind="stable")
        doc, lo, n = (r[k][done][order] for k in ("doc", "lo", "n"))
        ids = texts.column("doc_id").to_pylist()

        def cover(k: int, size: int) -> np.ndarray:
            a, b = np.searchsorted(doc, [ids[k], ids[k] + 1])
            change = np.zeros(size + 1, np.int32)
            np.add.at(change, np.minimum(lo[a:b], size), 1)
            np.add.at(change, np.minimum(lo[a:b] + n[a:b] - 1 + spec.width, size), -1)
            return np.cumsum(change[:-1]) > 0

        out = finish(ids, texts.column("text"), cover)
        for name in names:
            out = out.append_column(name, texts.column(name))
        return out

    names = [f.name for f in carried]
    schema = T.StructType([*T.StructType.fromDDL(schema).fields, *carried])
    return texts.groupBy("bucket").cogroup(blocks.groupBy("bucket")).applyInArrow(run, schema)


def keyed(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, text and carried columns, a null id as the smallest number."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text", *carried)


def unkeyed(result: DataFrame) -> DataFrame:
    return result.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))

"""Quality classifier by co-training two views of a document.

The text view is what the whole text says and how it looks: its word 1- and 2-grams,
hashed into ``GRAMS`` slots (log counts, scaled to length one), and a few shares and
ratios (letters, capitals, symbols, repeated words, ...). The metadata view is source,
language and length. Each view has a sparse logistic regression. Starting from the
labelled rows, in every round each view labels the unlabelled rows it is surest of, and
these join the other view's training rows. At the end each view is calibrated on labelled
rows kept apart, and the two log odds are added (less the prior's, which both hold).

Fitting uses bounded samples, picked by a hash of doc_id: at most ``LABELLED``
labelled and ``POOL`` unlabelled rows, some 6 bytes for each slot in use (a row has at
most ``GRAMS`` of them, however long its text). Every row is then scored by a map over
whole texts without a shuffle; what is broadcast is the two weight vectors.

Defined cases: null or empty texts have a text view of zeros; a text of any length is
read whole, by its counts; null metadata is a value of its own; labels that are null are
ignored, several labels of one doc_id count as their mean; without labels every score is
0.5; repeated rows are scored each, and of several rows of one doc_id the smallest (by
text, then metadata) is the one to fit on; rows that a view is equally sure of are taken
by ascending doc_id, and a score of exactly 0.5 is kept; a table without rows gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchfold.llm.common import WordHasher, doc_groups, mix64, read_table, row_bounds, run_starts, text_buffer

LABELLED, POOL = 12_000, 12_000
ROUNDS = 5
SURE = 0.97                      # calibrated probability of a pseudo-label
PER_ROUND = 0.1                  # of the pool, that one view may label in a round
PRIOR_WEIGHT = 1.0               # ridge penalty
SOURCES, LANGUAGES, LENGTHS = 64, 16, 12
KINDS = 8                        # kinds of bytes counted for the text view
SHAPE = KINDS + 5                # slots of the shares and ratios, before those of the grams
GRAM_BITS = 12
GRAMS = 1 << GRAM_BITS
TEXT_WIDTH = SHAPE + GRAMS
META_WIDTH = SOURCES + LANGUAGES + LENGTHS
ROWS_AT_ONCE = 512               # of a sample, in one numpy operation
SOLVER_STEPS = 40                # of conjugate gradients for one Newton step
META = ["text", "source", "lang", "n_chars"]
RESULT = "doc_id long, p_text double, p_metadata double, score double, keep boolean"


def byte_kinds() -> np.ndarray:
    """Kind of each byte: lower case, capital, digit, white space, stop or comma,
    quote or bracket, other symbol, part of a non-ASCII character."""
    kinds = np.full(256, 6)
    kinds[97:123], kinds[65:91], kinds[48:58], kinds[128:] = 0, 1, 2, 7
    kinds[[32, *range(9, 14)]] = 3
    kinds[[ord(c) for c in ".,;:?"]] = 4
    kinds[[ord(c) for c in "'\"()-"]] = 5
    return kinds


class Rows:
    """Sparse rows: row k has ``values`` in ``slots`` from ``bounds[k]`` to ``bounds[k + 1]``. Slots
    and values keep the narrow types they come in, and a few hundred rows are worked on at a time."""

    def __init__(self, slots, values, bounds, width: int):
        self.slots, self.values = np.asarray(slots), np.asarray(values)
        self.bounds, self.width = np.asarray(bounds, np.int64), width

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def groups(self):
        """(first row, row after the last, their slots, values and numbers of values)."""
        for a in range(0, len(self), ROWS_AT_ONCE):
            own = self.bounds[a:a + ROWS_AT_ONCE + 1]
            yield a, a + len(own) - 1, self.slots[own[0]:own[-1]], self.values[own[0]:own[-1]], np.diff(own)

    def dot(self, w: np.ndarray) -> np.ndarray:
        """One number a row."""
        out = np.zeros(len(self))
        for a, b, slots, values, n in self.groups():
            if len(values):                          # reduceat has no empty stretches
                out[a:b][n > 0] = np.add.reduceat(values * w[slots], (np.cumsum(n) - n)[n > 0])
        return out

    def sums(self, r: np.ndarray, power: int = 1) -> np.ndarray:
        """One number a slot, rows weighted by ``r``."""
        out = np.zeros(self.width)
        for a, b, slots, values, n in self.groups():
            weights = values.astype(np.float64) ** power * np.repeat(r[a:b], n)
            out += np.bincount(slots, weights=weights, minlength=self.width)
        return out

    def take(self, at: np.ndarray) -> Rows:
        return Rows.picked([(self, np.flatnonzero(at) if at.dtype == bool else at)])

    @staticmethod
    def joined(parts: list[Rows]) -> Rows:
        return Rows.picked([(p, np.arange(len(p))) for p in parts])

    @staticmethod
    def picked(parts: list[tuple[Rows, np.ndarray]]) -> Rows:
        """The named rows of some tables, copied once."""
        lengths = np.concatenate([np.diff(p.bounds)[at] for p, at in parts])
        bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        slots, values = (np.empty(bounds[-1], np.result_type(*(getattr(p, c) for p, _ in parts)))
                         for c in ("slots", "values"))
        row = 0
        for p, at in parts:
            for lo in range(0, len(at), ROWS_AT_ONCE):
                some = at[lo:lo + ROWS_AT_ONCE]
                own = bounds[row:row + len(some) + 1]
                places = np.repeat(p.bounds[some] - own[:-1], np.diff(own)) + np.arange(own[0], own[-1])
                slots[own[0]:own[-1]], values[own[0]:own[-1]] = p.slots[places], p.values[places]
                row += len(some)
        return Rows(slots, values, bounds, parts[0][0].width)


def as_rows(x) -> Rows:
    """``x`` itself, or the rows of a dense matrix."""
    if isinstance(x, Rows):
        return x
    row, slots = np.nonzero(x)
    return Rows(slots, x[row, slots], row_bounds(row, len(x)), x.shape[1])


class TextView:
    """The text view of a group of rows."""

    def __init__(self):
        self.kinds, self.hasher = byte_kinds(), WordHasher(lower=True)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> Rows:
        n = len(offsets) - 1
        words, rows, starts, ends = self.hasher(data, offsets)
        shape = self.shape(data, offsets, words, rows, starts, ends)
        row, slot, value = self.grams(words, rows, n)
        shape_row, shape_slot = np.nonzero(shape)
        row, slot = np.concatenate([shape_row, row]), np.concatenate([shape_slot, slot + SHAPE])
        value = np.concatenate([shape[shape_row, shape_slot], value])
        order = np.argsort(row, kind="stable")
        return Rows(slot[order], value[order], row_bounds(row[order], n), TEXT_WIDTH)

    def shape(self, data, offsets, words, rows, starts, ends) -> np.ndarray:
        n = len(offsets) - 1
        size = np.diff(offsets)
        owner = np.repeat(np.arange(n), size)
        counts = np.bincount(owner * KINDS + self.kinds[data], minlength=n * KINDS).reshape(n, KINDS)
        bounds = row_bounds(rows, n)
        per_row = np.maximum(np.diff(bounds), 1)
        repeated = np.zeros(n)
        if len(words) > 1:
            same = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
            repeated = np.bincount(rows[1:][same], minlength=n) / per_row
        order = np.lexsort((words, rows))
        new = run_starts(words[order], rows[order])
        distinct = np.bincount(rows[order][new], minlength=n) / per_row
        length = np.bincount(rows, weights=ends - starts, minlength=n) / per_row
        shares = counts / np.maximum(size, 1)[:, None]
        out = np.column_stack([shares, repeated, distinct, length / 10,
                               np.log1p(np.diff(bounds)) / 10, np.sqrt(shares[:, 6])])
        out[size == 0] = 0
        return out

    @staticmethod
    def grams(words, rows, n: int):
        """(row, slot, value) of the hashed word 1- and 2-grams; a row's values have length one."""
        pair = np.flatnonzero(rows[1:] == rows[:-1])
        hashes = np.concatenate([mix64(words), mix64(words[pair] * np.uint64(0xD6E8FEB86659FD93) + words[pair + 1])])
        row = np.concatenate([rows, rows[pair]])
        slot = (hashes >> np.uint64(64 - GRAM_BITS)).astype(np.int64)
        key, count = np.unique(row * GRAMS + slot, return_counts=True)
        row, slot, value = key // GRAMS, key % GRAMS, np.log1p(count)
        norm = np.sqrt(np.bincount(row, weights=value * value, minlength=n))
        return row, slot, value / norm[row]


def metadata_slots(source, lang, n_chars) -> list[int]:
    """The three slots of a row's metadata that are set."""
    slot = lambda value, size: 0 if value is None else 1 + zlib.crc32(str(value).encode()) % (size - 1)
    length = 0 if n_chars is None else min(LENGTHS - 1, 1 + int(max(0, n_chars)).bit_length() // 2)
    return [slot(source, SOURCES), SOURCES + slot(lang, LANGUAGES), SOURCES + LANGUAGES + length]


def views(docs: DataFrame) -> DataFrame:
    """doc_id, the text view (slots as 16-bit, values as 32-bit numbers) and metadata slots of each row."""
    def run(batches):
        view = TextView()
        for batch in batches:
            text = _text_view(view, batch)
            cut = list(zip(text.bounds[:-1].tolist(), text.bounds[1:].tolist()))
            slots, values = text.slots.astype(np.uint16), text.values.astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()),
                 pa.array([slots[a:b].tobytes() for a, b in cut], pa.binary()),
                 pa.array([values[a:b].tobytes() for a, b in cut], pa.binary()),
                 pa.array(_metadata(batch), pa.list_(pa.int32()))], names=["doc_id", "slots", "values", "metadata"])

    return docs.select("doc_id", *META).mapInArrow(
        run, "doc_id long, slots binary, values binary, metadata array<int>")


def _text_view(view: TextView, batch) -> Rows:
    data, offsets = text_buffer(batch.column(1))
    parts = [view(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in doc_groups(offsets)]
    return Rows.joined(parts) if parts else Rows(np.zeros(0, np.int64), np.zeros(0), [0], TEXT_WIDTH)


def _metadata(batch) -> list[list[int]]:
    return [metadata_slots(*row) for row in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))]


def logistic(x, y: np.ndarray, penalty: float = PRIOR_WEIGHT, steps: int = 25, start=None) -> np.ndarray:
    """Weights (the last is the intercept) by Newton's method with a ridge penalty. The steps are
    solved by conjugate gradients, which need only products with the sparse rows."""
    x = as_rows(x)
    ridge = np.full(x.width + 1, penalty)
    ridge[-1] = 1e-3
    w = np.zeros(x.width + 1) if start is None else start.copy()

    def loss(w, z):
        return float((np.logaddexp(0, z) - y * z).sum() + (ridge * w * w).sum() / 2)

    z = x.dot(w[:-1]) + w[-1]
    for _ in range(steps):
        p = sigmoid(z)
        curve = p * (1 - p) + 1e-9
        gradient = np.append(x.sums(p - y), (p - y).sum()) + ridge * w
        diagonal = np.append(x.sums(curve, power=2), curve.sum()) + ridge

        def times(v):
            u = curve * (x.dot(v[:-1]) + v[-1])
            return np.append(x.sums(u), u.sum()) + ridge * v

        step = solve(times, gradient, diagonal)
        before, size = loss(w, z), 1.0
        while True:                                  # a whole step nearly always
            z = x.dot((w - size * step)[:-1]) + (w - size * step)[-1]
            if size < 1e-3 or loss(w - size * step, z) <= before:
                break
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-4:
            break
    return w


def solve(times, target: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
    """Conjugate gradients, scaled by the diagonal."""
    out, rest = np.zeros(len(target)), target.copy()
    scaled = rest / diagonal
    way, size = scaled.copy(), float(rest @ scaled)
    small = 1e-8 * size
    for _ in range(SOLVER_STEPS):
        if size <= small:
            break
        ahead = times(way)
        by = size / float(way @ ahead)
        out += by * way
        rest -= by * ahead
        scaled = rest / diagonal
        size, last = float(rest @ scaled), size
        way = scaled + size / last * way
    return out


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def odds(x, model) -> np.ndarray:
    """Calibrated log odds of a view."""
    w, (slope, shift) = model
    return slope * (as_rows(x).dot(w[:-1]) + w[-1]) + shift


def calibrated(x, y, x_apart, y_apart, start=None):
    """A view's weights with the line that maps its log odds to those seen on rows kept apart."""
    w = logistic(x, y, start=start)
    raw = x_apart.dot(w[:-1]) + w[-1]
    if len(set(y_apart)) < 2:
        return w, (1.0, 0.0)
    slope, shift = logistic(raw[:, None], y_apart, penalty=1e-2)
    return w, (max(slope, 1e-3), shift)


def co_train(text, slots, y, apart, pool_text, pool_slots, rounds: int = ROUNDS):
    """Both views' models after the exchange of pseudo-labels."""
    own = [(as_rows(text), as_rows(pool_text)), (as_rows(slots), as_rows(pool_slots))]
    known = np.flatnonzero(~apart)
    kept_apart = [x.take(apart) for x, _ in own]
    in_pool = len(own[0][1])
    taken = [np.zeros(in_pool, bool), np.zeros(in_pool, bool)]
    added: list[list] = [[], []]               # (pool rows, labels) that the other view gave
    limit = max(1, int(PER_ROUND * in_pool))

    def train(v, start=None):
        rows = [(own[v][0], known), *((own[v][1], at) for at, _ in added[v])]
        labels = [y[~apart], *(label for _, label in added[v])]
        return calibrated(Rows.picked(rows), np.concatenate(labels), kept_apart[v], y[apart], start)

    models = [train(0), train(1)]
    for _ in range(rounds if in_pool else 0):
        for v in (0, 1):
            p = sigmoid(odds(own[v][1], models[v]))
            free = ~taken[1 - v]
            sure = np.flatnonzero(free & (np.maximum(p, 1 - p) >= SURE))
            sure = sure[np.argsort(-np.maximum(p, 1 - p)[sure], kind="stable")][:limit]
            taken[1 - v][sure] = True
            added[1 - v].append((sure, (p[sure] > 0.5).astype(float)))
        models = [train(v, models[v][0]) for v in (0, 1)]
    return models


def _collected(rows: DataFrame) -> tuple[pa.Table, Rows, Rows]:
    """The rows of a sample by doc_id (without their views) and both their views. They arrive as
    Arrow buffers, some 6 bytes a value, and are copied once to be put in order."""
    table = rows.toArrow()
    table = table.take(pa.compute.sort_indices(table, [("doc_id", "ascending")])).combine_chunks()
    views = []
    for name, kind in (("slots", np.uint16), ("values", np.float32)):
        column = table.column(name).combine_chunks()
        if not len(column):
            views.append(np.zeros(0, kind))
            continue
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        views.append(np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind))
        bounds = (ends.astype(np.int64) - ends[0]) // np.dtype(kind).itemsize
    bounds = bounds if len(table) else np.zeros(1, np.int64)
    meta = table.column("metadata").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.uint16)
    return (table.drop_columns(["slots", "values", "metadata"]), Rows(*views, bounds, TEXT_WIDTH),
            Rows(meta, np.ones(len(meta), np.float32), 3 * np.arange(len(table) + 1), META_WIDTH))


def _sampled(docs: DataFrame, rows: int, bound: int) -> DataFrame:
    share = min(1.0, bound / max(rows, 1))
    return docs.filter(F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1_000_000)) < share * 1e6)


def _one_each(docs: DataFrame) -> DataFrame:
    """Of several rows of one doc_id the smallest; for samples only."""
    return (docs.groupBy("doc_id").agg(F.min(F.struct(*META)).alias("row")).select("doc_id", "row.*"))


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL):
    """((text model, metadata model), prior log odds), or None without labels."""
    docs = docs.select("doc_id", *META).filter("doc_id IS NOT NULL")
    labels = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
              .agg(F.avg("quality").alias("y")))
    n_labels, total = labels.count(), docs.select("doc_id").count()
    chosen = _sampled(labels, n_labels, labelled)
    known = _sampled(docs, n_labels, labelled).join(chosen.select("doc_id"), "doc_id", "left_semi")
    rows, text, meta = _collected(views(_one_each(known)).join(chosen, "doc_id"))
    if not len(rows):
        return None
    y = (rows.column("y").to_numpy() >= 0.5).astype(float)
    apart = np.array([zlib.crc32(str(k).encode()) % 5 == 0 for k in rows.column("doc_id").to_pylist()])
    if not apart.any() or apart.all():
        apart = np.arange(len(rows)) % 5 == 4
    if not (~apart).any():
        return None
    loose = _sampled(docs, total, pool).join(labels.select("doc_id"), "doc_id", "left_anti")
    _, pool_text, pool_meta = _collected(views(_one_each(loose)))
    models = co_train(text, meta, y, apart, pool_text, pool_meta)
    share = (y.sum() + 1) / (len(y) + 2)
    return models, float(np.log(share / (1 - share)))


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id, both views' probabilities, the combined score, and whether to keep the row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        view = TextView()
        for batch in batches:
            n = batch.num_rows
            if shared.value is None:
                p_text = p_meta = both = np.full(n, 0.5)
            else:
                (text_model, meta_model), prior = shared.value
                a = odds(_text_view(view, batch), text_model)
                w, (slope, shift) = meta_model
                slots = np.array(_metadata(batch), np.int64).reshape(n, 3)
                b = slope * (w[slots].sum(1) + w[-1]) + shift
                p_text, p_meta, both = sigmoid(a), sigmoid(b), sigmoid(a + b - prior)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(p_text), pa.array(p_meta), pa.array(both),
                 pa.array(both >= 0.5)], names=["doc_id", "p_text", "p_metadata", "score", "keep"])

    return docs.select("doc_id", *META).mapInArrow(run, RESULT)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, fit(docs, read_table(spark, sf_dir, "labels")))


QUERIES = {"op10_quality": op10_quality}

"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries c become integers x = floor(64 c) + 1000000. The leading unit eigenvectors of the
covariance of x are found without forming it: a block Q of k + ``GUARD`` columns is
multiplied by centred X'X / n in distributed passes. Each pass centres a task's rows
(exactly, from the integer sums), adds up X'(XQ) over them and lets Spark add the
tasks' sums in ``SLOTS`` groups; the driver holds a dimensions x block matrix.

A cycle is a polynomial of degree ``DEGREE`` in the covariance, by the three-term Chebyshev
recurrence, that damps the unwanted spectrum [a, b] and lets what is above grow, then
QR and Rayleigh-Ritz. b is the block's smallest Ritz value. a is a lower bound of the
spectrum: a Lanczos column travels along with the first cycle's passes (before it
is known, a = 0). Columns are Ritz vectors, largest first, so that QR keeps the small ones apart from
what the large ones leave in them.

The iteration ends when it is certified: every wanted pair's residual |V q - e q| is
at most ``TOLERANCE`` x the largest eigenvalue, about what double precision can show. If ``PATIENCE``
cycles do not get there (a flat spectrum has no gap behind the block), the block
grows by ``GUARD`` columns, at most to all dimensions, where Rayleigh-Ritz alone is exact.

Whitened rows are (x - S/n) on the components over sqrt(e). ``deviation``, the squared distance to
the mean times n squared, is exact, as a decimal.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are left out;
vectors of different lengths are fitted apart, each length on its own rows; components with
an eigenvalue of at most ``NEGLIGIBLE`` x the largest (constant dimensions, fewer rows than dimensions,
equal rows) cannot be whitened and are not returned, so rows of a table without variance
give none; on equal eigenvalues any basis may come, the same for all rows; repeated rows each
count and are each returned; a null id is kept; a table without rows gives none;
other columns are ignored. Entries of 2**52 or more after scaling are an error.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchfold.llm.common import materialise, read_table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS, GUARD, DEGREE = 32, 16, 8
TOLERANCE = 2e-14
NEGLIGIBLE = 1e-10
PATIENCE = 6
SLOTS = 16                       # groups in which the tasks' sums are added
ROWS = 4_096                     # vectors of one numpy pass
LARGEST = 1 << 52
SEED = 12
WIDE = decimal.Context(prec=38)


# --- the fit list ----------------------------------------------------------------

def finite_rows(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, x: the vectors that count, as doubles."""
    return (vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
            .filter((F.size("x") > 0) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)
                                                 & (F.abs(v) < float("inf")))))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of one length and their integers less ``SHIFT``."""
    for batch in batches:
        for part in (batch.slice(lo, ROWS) for lo in range(0, batch.num_rows, ROWS)):
            lengths = np.asarray(part.column("x").value_lengths().to_numpy())
            for dims in np.unique(lengths).tolist():
                own = part.filter(pa.array(lengths == dims))
                x = np.floor(own.column("x").flatten().to_numpy().reshape(-1, dims) * SCALE)
                if np.abs(x).max() >= LARGEST:
                    raise ValueError("an entry is 2**52 or more after scaling")
                yield own, x.astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, x in _matrices(batches):
        small = np.abs(x).max() < 1 << 31
        yield pa.record_batch([pa.array([x.shape[1]], pa.int32()), pa.array([bool(small)]),
                               pa.array([x.astype(np.int32 if small else np.int64).tobytes()], pa.binary())],
                              ["dims", "small", "data"])


def _block_values(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for dims, small, data in zip(*(batch.column(c).to_pylist() for c in ("dims", "small", "data"))):
            yield np.frombuffer(data, np.int32 if small else np.int64).reshape(-1, dims)


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for x in _block_values(batches):
        dims = x.shape[1]
        yield pa.record_batch([pa.array([dims] * dims, pa.int32()), pa.array(np.arange(dims, dtype=np.int32)),
                               pa.array(x.sum(0, dtype=np.int64)), pa.array([len(x)] * dims, pa.int64())],
                              ["dims", "dim", "total", "n"])


@dataclass
class Centre:
    """The mean S / n as integer and remainder: x - S/n = (x - whole) - rest / n."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(sums: list[int], n: int) -> Centre:
        return Centre(n, np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64))

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of (n x - S)**2 of each row, exact."""
        d = x - self.whole
        if float(np.abs(d).max() + 1) * self.n < (2.0 ** 62 / x.shape[1]) ** 0.5:
            return ((d * self.n - self.rest) ** 2).sum(1).tolist()
        return ((d.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(1).tolist()


# --- passes ----------------------------------------------------------------------

def add_up(blocks: DataFrame, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``work(x)`` (doubles of one shape) over all blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = None
        for x in _block_values(batches):
            part = work(x)
            total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId() % SLOTS], pa.int32()),
                                   pa.array([total.tobytes()], pa.binary())], ["slot", "data"])

    def merge(rows: pa.Table) -> pa.Table:
        data = sum(np.frombuffer(b.as_buffer(), np.float64) for b in rows.column("data"))
        return pa.table({"slot": rows.column("slot")[:1], "data": pa.array([data.tobytes()], pa.binary())})

    parts = blocks.mapInArrow(run, "slot int, data binary").groupBy("slot").applyInArrow(merge, "slot int, data binary")
    rows = sorted(parts.collect(), key=lambda r: r.slot)              # SLOTS rows at most
    return sum(np.frombuffer(bytes(r.data), np.float64) for r in rows) if rows else None


def covariance_pass(blocks: DataFrame, centre: Centre) -> Callable[[np.ndarray], np.ndarray]:
    """q -> V q, one distributed pass over the rows."""
    def product(q: np.ndarray) -> np.ndarray:
        def work(x):
            c = centre.apply(x)
            return c.T @ (c @ q)
        return add_up(blocks, work).reshape(q.shape) / centre.n
    return product


class Lanczos:
    """An estimated lower bound of a symmetric matrix's spectrum, one product at a time: the
    smallest Ritz value less its residual. (Too high a bound only slows the filter.)"""

    def __init__(self, dims: int, dice: np.random.Generator):
        v = dice.normal(size=dims)
        self.basis, self.alpha, self.beta = [v / np.linalg.norm(v)], [], []

    def column(self) -> np.ndarray:
        return self.basis[-1]

    def step(self, product: np.ndarray) -> None:
        self.alpha.append(float(self.basis[-1] @ product))
        known = np.array(self.basis)
        rest = product - known.T @ (known @ product)
        rest -= known.T @ (known @ rest)
        size = float(np.linalg.norm(rest))
        self.beta.append(size)
        self.basis.append(rest / size if size > 1e-300 else np.zeros_like(rest))

    def lower(self) -> float:
        k = len(self.alpha)
        if not k:
            return 0.0
        values, vectors = np.linalg.eigh(np.diag(self.alpha) + np.diag(self.beta[:k - 1], 1) + np.diag(self.beta[:k - 1], -1))
        return max(0.0, float(values[0] - abs(self.beta[-1] * vectors[-1, 0])))


@dataclass
class Eigen:
    values: np.ndarray           # falling
    vectors: np.ndarray          # dimensions x components, unit columns
    residual: float              # largest, over the largest eigenvalue
    passes: int


def leading_eigenpairs(product: Callable[[np.ndarray], np.ndarray], dims: int, k: int = COMPONENTS, guard: int = GUARD,
                       degree: int = DEGREE, tolerance: float = TOLERANCE, patience: int = PATIENCE,
                       seed: int = SEED) -> Eigen:
    """The ``k`` largest eigenpairs of the positive matrix that ``product`` multiplies by."""
    dice = np.random.default_rng(seed)
    k, width = min(k, dims), min(dims, k + guard)
    q = np.linalg.qr(dice.normal(size=(dims, width)))[0]
    lanczos, low, cycles, passes, best = Lanczos(dims, dice), 0.0, 0, 0, None

    def multiply(y):
        nonlocal passes
        passes += 1
        return product(y)

    while True:
        w = multiply(q)
        values, rotation = np.linalg.eigh((q.T @ w + w.T @ q) / 2)                 # Rayleigh-Ritz
        order = np.argsort(values)[::-1]
        values, rotation = values[order], rotation[:, order]
        q, w = q @ rotation, w @ rotation
        top = max(values[0], 0.0)
        residual = float(np.linalg.norm(w[:, :k] - q[:, :k] * values[:k], axis=0).max() / top) if top > 0 else 0.0
        if best is None or residual < best.residual:
            best = Eigen(values[:k], q[:, :k], residual, passes)
        if residual <= tolerance or width == dims:
            best.passes = passes
            return best
        if cycles and cycles % patience == 0:                                      # no gap behind the block: widen it
            width = min(dims, width + guard)
            q = np.linalg.qr(np.column_stack([q, dice.normal(size=(dims, width - q.shape[1]))]))[0]
            cycles += 1
            continue
        high = max(values[-1], 1e-12 * top)
        low = low if low < 0.999 * high else 0.999 * high
        half, middle = (high - low) / 2, (high + low) / 2
        sigma = first = half / (top - middle)
        before, y = q, (w - middle * q) * (sigma / half)                           # w is the first product
        for _ in range(degree - 1):
            if cycles:
                z = multiply(y)
            else:
                both = multiply(np.column_stack([y, lanczos.column()]))
                z = both[:, :-1]
                lanczos.step(both[:, -1])
            following = 1 / (2 / first - sigma)
            before, y = y, (z - middle * y) * (2 * following / half) - (sigma * following) * before
            sigma = following
        if not cycles:
            low = lanczos.lower()
        q = np.linalg.qr(y / np.maximum(np.linalg.norm(y, axis=0), 1e-300))[0]
        cycles += 1


# --- whitening -------------------------------------------------------------------

@dataclass
class Fit:
    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    passes: int
    residual: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (self.centre.apply(x) @ self.vectors) / np.sqrt(self.values)


def fit(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id",
        vector: str = "embedding") -> dict[int, Fit]:
    """The fit of the vectors of each length."""
    rows = finite_rows(vectors, vec_id, vector)
    blocks = materialise(rows.select("x").mapInArrow(_blocks, "dims int, small boolean, data binary"))
    sums: dict[int, list] = {}
    total = blocks.mapInArrow(_block_sums, "dims int, dim int, total bigint, n bigint") \
        .groupBy("dims", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    for r in sorted(total.collect(), key=lambda r: (r.dims, r.dim)):               # one row a dimension
        sums.setdefault(r.dims, []).append((int(r.total), r.n))
    fits = {}
    for dims, cells in sums.items():
        own = blocks.filter(F.col("dims") == dims)
        centre = Centre.of([s for s, _ in cells], cells[0][1])
        variances = add_up(own, lambda x: (centre.apply(x) ** 2).sum(0)) / centre.n
        trace = float(variances.sum())
        if trace == 0:
            continue
        eigen = leading_eigenpairs(covariance_pass(own, centre), dims, components)
        keep = eigen.values > NEGLIGIBLE * eigen.values[0]
        vectors_kept = eigen.vectors[:, keep]
        sign = np.sign(vectors_kept[np.abs(vectors_kept).argmax(0), np.arange(vectors_kept.shape[1])])
        found = Fit(centre, eigen.values[keep], vectors_kept * sign, trace, 0.0, eigen.passes, eigen.residual)
        found.identity_error = _identity_error(own, found)
        fits[dims] = found
    return fits


def _identity_error(blocks: DataFrame, fitted: Fit) -> float:
    k = len(fitted.values)

    def work(x):
        z = fitted.whiten(x)
        return np.vstack([z.T @ z, z.sum(0)])
    moments = add_up(blocks, work).reshape(k + 1, k) / fitted.centre.n
    return float(np.abs(moments[:-1] - np.outer(moments[-1], moments[-1]) - np.eye(k)).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id",
             vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error: a row for each
    vector that counts and each of its components."""
    rows = finite_rows(vectors, vec_id, vector)
    kind = rows.schema["vec_id"].dataType.simpleString()
    fits = fit(vectors, components, vec_id, vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, x in _matrices(batches):
            f = fits.get(x.shape[1])
            if f is None:
                continue
            k, ids = len(f.values), np.repeat(np.arange(len(x)), len(f.values))
            deviation = pa.array([WIDE.create_decimal(d) for d in f.centre.deviations(x)], pa.decimal128(38, 0))
            yield pa.record_batch(
                [own.column("vec_id").take(pa.array(ids)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(ids), f.centre.n)), deviation.take(pa.array(ids)), pa.array(f.whiten(x).ravel()),
                 pa.array(np.tile(f.values / f.trace, len(x))), pa.array(np.full(len(ids), f.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, "
                                "explained double, identity_error double")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` as a long; null where it does not fit one (the operator's own decimal does)."""
    out = whitened(read_table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


QUERIES = {"op12_whitening": op12_whitening}

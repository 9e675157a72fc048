"""Helpers shared by the corpus operators: Arrow text buffers, word hashes, blocks.

Texts reach Python as Arrow buffers and are worked on with numpy, half a
megabyte at a time, so a task's memory does not depend on the number of rows
of its partition. Only one document at a time has to fit.
"""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from watchfold.session import ensure_checkpoint_dir

GROUP_BYTES = 500_000            # text handled by one numpy pass (some 30 times that in arrays)
RELEASE_PAUSE = 0.25             # seconds
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MASK64 = (1 << 64) - 1
ROLL_BASE = 0x9E3779B97F4A7C15   # odd, so it has an inverse modulo 2**64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and read it from there. The
    shuffle files of that job are removed at its end, not when the driver collects its garbage."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:                                       # a query of its own, made under this setting
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def release(spark: SparkSession) -> None:
    """Let go of shuffle files that nothing refers to any more: Spark removes them when the
    driver's garbage is collected, which can take long on a driver that does little. Python's
    references reach the JVM a moment after they are gone, so it collects only then."""
    for _ in range(2):
        gc.collect()
        time.sleep(RELEASE_PAUSE)
        spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return a Python worker's free memory to the system, at the start or end of a task: workers are kept
    between stages, and Arrow's pool and the C heap keep what a task has used."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):    # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- Arrow text ------------------------------------------------------------------

def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null takes no bytes."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def doc_groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive rows of at most ``limit`` bytes together; a longer row stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = max(lo + 1, min(hi, n))
        yield lo, hi
        lo = hi


# --- hashes ----------------------------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply); a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(seed: int) -> np.ndarray:
    """A random odd 64-bit value per byte value, the same in every process."""
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(ROLL_BASE)
                 + np.uint64(seed)) | np.uint64(1)


class Rolling:
    """Hashes of any byte range of a buffer from one prefix sum (polynomial modulo 2**64)."""

    def __init__(self, seed: int = 7, base: int = ROLL_BASE):
        self.table = byte_table(seed)
        self.base = base
        self.inverse = pow(base, -1, 1 << 64)
        self.powers = np.zeros(0, np.uint64)
        self.inverses = np.zeros(0, np.uint64)

    def load(self, data: np.ndarray, table: np.ndarray | None = None) -> None:
        self.load_values((self.table if table is None else table)[data])

    def load_values(self, values: np.ndarray) -> None:
        n = len(values)
        if len(self.powers) < n + 1:
            size = max(n + 1, GROUP_BYTES + 1)
            self.powers = _geometric(self.base, size)
            self.inverses = _geometric(self.inverse, size)
        values = values * self.powers[:n]
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values, out=self.prefix[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self.prefix[ends]
        out -= self.prefix[starts]
        out *= self.inverses[starts]
        return out

    def windows(self, width: int) -> np.ndarray:
        """The hash of every range of ``width`` bytes."""
        n = len(self.prefix) - 1
        if n < width:
            return np.zeros(0, np.uint64)
        out = self.prefix[width:] - self.prefix[:n - width + 1]
        out *= self.inverses[:n - width + 1]
        return out


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class WordHasher:
    """Words of a group of rows as 64-bit hashes; by default ``[^\\x20\\x09-\\x0D]+``."""

    def __init__(self, lower: bool = False, seed: int = 7, separators: np.ndarray = SEPARATORS):
        self.separators = separators
        self.rolling = Rolling(seed)
        self.table = self.rolling.table.copy()
        if lower:                      # only A-Z: a UTF-8 byte above 127 is never a letter here
            self.table[65:91] = self.table[97:123]

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """(hash, row, start, end) of each word; ``offsets`` start at 0 of ``data``."""
        n = len(data)
        if not n:
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), none, none, none
        inside = ~self.separators[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True           # a row's first byte, or the end
        left = np.empty(n, bool)
        left[0] = True
        left[1:] = ~inside[:-1]
        starts = np.flatnonzero(inside & (left | edge[:-1]))
        right = np.empty(n, bool)
        right[-1] = True
        right[:-1] = ~inside[1:]
        ends = np.flatnonzero(inside & (right | edge[1:])) + 1
        self.rolling.load(data, self.table)
        hashes = mix64(self.rolling.of(starts, ends) + (ends - starts).astype(np.uint64))
        rows = np.searchsorted(offsets, starts, "right") - 1
        return hashes, rows, starts, ends


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each of ``n`` rows in an array sorted by row."""
    return np.searchsorted(rows, np.arange(n + 1))


# --- blocks: many small records of one bucket in one shuffled row ------------------

def bucket_slices(buckets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by bucket and the bounds of each bucket in it."""
    order = np.argsort(buckets, kind="stable")
    return order, np.searchsorted(buckets[order], np.arange(n + 1))


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """True where a sorted record differs from the one before it in any column."""
    n = len(columns[0])
    out = np.zeros(n, bool)
    if n:
        out[0] = True
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out

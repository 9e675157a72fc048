"""Centroid clustering on bit planes: exact integer k-means by AND and popcount.

A vector's components x become integers floor(64 x). Bit b of all 64 components is one
64-bit word, the vector's plane b (two's complement, so the top plane weighs
-2**b). With the planes of vectors and centroids

    x . c = sum over planes a, b of weight(a) weight(b) popcount(x_a AND c_b)

and |x - c|^2 = x.x - 2 x.c + c.c, all in exact integer arithmetic. The planes are packed
once and written; each round assigns all vectors in one pass over the planes and adds
up their bits by cluster inside each task, and Spark sums the tasks' sums. Only the
centroids and these sums (clusters x 64 numbers) are ever on the driver. The number of
planes is that of the largest component of all data.

Initial centroids are the vectors with the smallest sha256 of ``<seed>:<vec_id>``.
Each of ``ROUNDS`` rounds assigns (ties: smaller number) and replaces every centroid that
has vectors by their componentwise floor(sum / count), which Python's integers
divide exactly; an empty one stays. A last pass assigns once more.

Defined cases: vectors that are null, of another length, or that hold null or
non-finite components are left out; rows with a null id are kept, last among the
candidates for initial centroids; of equal ids the vector that sorts first
comes first; with fewer vectors than centroids there are as many centroids as vectors;
repeated rows each count and are each returned; a table without kept rows gives none;
other columns are ignored. Components of 2**27 or more after scaling are an error,
as a squared distance would no longer fit a long (and so is a sum of distances that does not).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchfold.llm.common import materialise, read_table

DIMS = 64                        # one bit of each fills a word
SCALE = 64
CLUSTERS, ROUNDS, SEED = 16, 3, 1
LARGEST = 1 << 27
ROWS = 4_096                     # vectors of one numpy pass


def finite(column) -> F.Column:
    """No component is null, NaN or infinite."""
    x = F.col(column)
    return F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                    & (F.abs(v.cast("double")) < float("inf")))


def kept(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and the integers ``v`` of the vectors that count."""
    return (vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("x"))
            .filter((F.size("x") == DIMS) & finite("x"))
            .select("vec_id", F.transform("x", lambda v: F.floor(v.cast("double") * SCALE)).alias("v")))


# --- planes ----------------------------------------------------------------------

def plane_count(low: int, high: int) -> int:
    """Bits of two's complement that hold every integer from ``low`` to ``high``."""
    return max((~low if low < 0 else low).bit_length(), (~high if high < 0 else high).bit_length()) + 1


def weights(planes: int) -> list[int]:
    return [1 << b for b in range(planes - 1)] + [-(1 << (planes - 1))]


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """Integers (rows, 64) as words (rows, planes)."""
    bits = (values[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view(np.uint64)[:, :, 0]


def dot(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """All dot products (rows, centroids) of two sets of planes."""
    w = weights(x.shape[1])
    out = np.zeros((len(x), len(c)), np.int64)
    for a, wa in enumerate(w):
        for b, wb in enumerate(w):
            out += np.bitwise_count(x[:, a, None] & c[None, :, b]).astype(np.int64) * (wa * wb)
    return out


def square(x: np.ndarray) -> np.ndarray:
    """The dot product of each vector with itself."""
    w = weights(x.shape[1])
    out = np.zeros(len(x), np.int64)
    for a, wa in enumerate(w):
        for b, wb in enumerate(w):
            out += np.bitwise_count(x[:, a] & x[:, b]).astype(np.int64) * (wa * wb)
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector; ties go to the smaller number."""
    distance = square(x)[:, None] - 2 * dot(x, c) + square(c)[None, :]
    cluster = distance.argmin(1)
    return cluster, distance[np.arange(len(x)), cluster]


def bit_sums(x: np.ndarray, cluster: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    """(component sums, sizes) of each cluster, counted from the planes."""
    sizes = np.bincount(cluster, minlength=clusters)
    order = np.argsort(cluster, kind="stable")
    bits = np.unpackbits(x[order].view(np.uint8).reshape(len(x), -1, 8), axis=2, bitorder="little")
    filled = np.flatnonzero(sizes)
    counts = np.add.reduceat(bits, (np.cumsum(sizes) - sizes)[filled], axis=0, dtype=np.int64)
    sums = np.zeros((clusters, DIMS), np.int64)
    sums[filled] = (counts * np.array(weights(x.shape[1]), np.int64)[None, :, None]).sum(1)
    return sums, sizes


def _packer(planes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(lo, ROWS) for lo in range(0, batch.num_rows, ROWS)):
                values = part.column("v").flatten().to_numpy().reshape(-1, DIMS)
                words = np.ascontiguousarray(pack(values, planes))
                yield pa.record_batch([part.column("vec_id"), pa.array([w.tobytes() for w in words], pa.binary())],
                                      ["vec_id", "planes"])
    return run


def _words(batch: pa.RecordBatch, planes: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for part in (batch.slice(lo, ROWS) for lo in range(0, batch.num_rows, ROWS)):
        raw = b"".join(part.column("planes").to_pylist())
        yield part, np.frombuffer(raw, np.uint64).reshape(-1, planes)


def _summer(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, sums, sizes = len(centroids), 0, 0
        for batch in batches:
            for _, x in _words(batch, centroids.shape[1]):
                s, n = bit_sums(x, nearest(x, centroids)[0], k)
                sums, sizes = sums + s, sizes + n
        if np.any(sizes):
            at = np.indices((k, DIMS))
            yield pa.record_batch([pa.array(at[0].ravel().astype(np.int32)), pa.array(at[1].ravel().astype(np.int32)),
                                   pa.array(sums.ravel()), pa.array(np.repeat(sizes, DIMS))],
                                  ["cluster", "component", "total", "n"])
    return run


def _assigner(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _words(batch, centroids.shape[1]):
                cluster, distance = nearest(x, centroids)
                yield pa.record_batch([part.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                      ["vec_id", "cluster", "distance"])
    return run


# --- rounds ----------------------------------------------------------------------

def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
                    vec_id: str = "vec_id", vector: str = "embedding"):
    """(assigned, centroids): vec_id, cluster, distance of every kept vector, and the final
    centroids as lists of integers, by number. ``assigned`` is written to the checkpoint folder."""
    rows = kept(vectors, vec_id, vector)
    kind = rows.schema["vec_id"].dataType.simpleString()
    bounds = rows.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    low, high = (bounds[0] or 0), (bounds[1] or 0)
    if low < -LARGEST or high >= LARGEST:
        raise ValueError(f"components from {low} to {high} after scaling; squared distances need less than 2**27")
    planes = plane_count(low, high)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(digest.asc_nulls_last(), "v").limit(clusters).collect()
    centroids = [list(r.v) for r in first]
    schema = f"vec_id {kind}, cluster int, distance bigint"
    if not centroids:
        return vectors.sparkSession.createDataFrame([], schema), []
    packed = materialise(rows.mapInArrow(_packer(planes), f"vec_id {kind}, planes binary"))
    words = lambda: pack(np.array(centroids, np.int64), planes)
    for _ in range(rounds):
        sums = packed.mapInArrow(_summer(words()), "cluster int, component int, total bigint, n bigint") \
            .groupBy("cluster", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        for r in sums.filter("n > 0").collect():         # clusters x 64 rows at most
            centroids[r.cluster][r.component] = r.total // r.n
    return materialise(packed.mapInArrow(_assigner(words()), schema)), centroids


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = cluster_vectors(read_table(spark, sf_dir, "embeddings"))
    sums = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    table = spark.createDataFrame(
        [(k, sums.get(k, 0), sum(sums.values()), centroid_digest(c)) for k, c in enumerate(centroids)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select(    # one row for each centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES = {"op11_centroid_clusters": op11_centroid_clusters}

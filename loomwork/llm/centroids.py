"""Centroid clustering of integer vectors by heap-ordered bounds.

Lloyd's rounds, where most vectors are never compared with all centroids again. Every vector carries an upper bound ``u``
of the distance to its own centroid and a lower bound ``l`` of the distance to every other one (both plain Euclidean, so
the triangle inequality holds). After a move of the centroids, ``u`` grows by at most the own centroid's drift and ``l``
shrinks by at most the largest drift of the others. Instead of updating every vector, each cluster keeps a heap: the key
of a vector is its gap ``l - u`` plus the cluster's accumulated drift at the time it was scanned, and the cluster's
accumulated drift grows by (own drift + largest other drift) every round. A vector whose key falls to the accumulated
drift may have a nearer centroid: it is popped and rescanned exactly; all others keep their centroid without a look. The
heaps are the state table itself, sorted within each partition by (cluster, key), so what expires is a prefix of every
cluster's run; the check is a predicate on the row and needs no shuffle.

Centroid sums change only by the vectors that move, so each round aggregates the moves alone (partial sums before the
shuffle, one group per cluster: a hot cluster is summed map-side). Centroids, drifts and accumulated drifts are ``k``
numbers and travel as literals; the state is stored in the shared folder after every round, so a lost executor
recomputes one round at most.

Exact results: distances are compared as exact integers (int64, or Python integers in a batch whose components pass
2^26); a bound that is not clearly clear (within a relative 1e-9) counts as expired, so float rounding can only cost
rescans, never a wrong assignment. Ties go to the smaller centroid number. Sums are decimal(38,0).

Defined cases: vectors of another length, with a null or non-finite component (or one whose floor(scale * x) is no long:
|x| >= 2^62 / scale), or null, are left out; a null id is a
vector of its own and comes after all ids when seeds are chosen; repeated rows are separate vectors (equal seeds give
equal centroids, the later number stays empty); with fewer kept vectors than ``k`` there are as many centroids as
vectors; an empty table gives an empty result. Only the id and the results are returned (join other columns back by id).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.session import cut_lineage

K = 40
ROUNDS = 5
DIM = 64
SCALE = 256
SEED_PREFIX = "2:"
EXACT_INT64 = 1 << 26
SLACK = 1e-9
CHUNK = 4096
LARGEST = float(1 << 62)
WIDE = "decimal(38,0)"


def kept_points(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, point): vectors of ``dim`` finite components, each turned into floor(scale * x) with x as double."""
    v = F.col(vector)
    fine = (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST / scale))
    return vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v")).where(F.coalesce(fine, F.lit(False))).select(
        "vec_id", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("point"))


def seed_key(vec_id: Column, prefix: str = SEED_PREFIX) -> Column:
    return F.sha2(F.concat(F.lit(prefix), vec_id.cast("string")), 256)


def seeds(points: DataFrame, k: int, prefix: str = SEED_PREFIX) -> list[list[int]]:
    """The ``k`` vectors of smallest seed hash in ascending order (ties by point): a top-k, ``k`` rows reach the driver."""
    rows = points.orderBy(seed_key(F.col("vec_id"), prefix).asc_nulls_last(), F.col("vec_id").asc_nulls_last(), "point").limit(k).collect()
    return [list(r["point"]) for r in rows]


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows x centroids."""
    if points.size and max(int(np.abs(points).max()), int(np.abs(centroids).max())) >= EXACT_INT64:
        p, c = points.astype(object), centroids.astype(object)
        return np.array([[sum((a - b) * (a - b) for a, b in zip(row, col)) for col in c] for row in p], dtype=object)
    p, c = points.astype(np.int64), centroids.astype(np.int64)
    return (p * p).sum(1)[:, None] - 2 * (p @ c.T) + (c * c).sum(1)[None, :]


def rescan(points: np.ndarray, centroids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (first on ties), its exact squared distance, and the heap key gap + accumulated drift."""
    d = distances(points, centroids)
    best = np.argmin(d, axis=1) if d.dtype != object else np.array([min(range(len(r)), key=lambda j: (r[j], j)) for r in d], dtype=np.int64)
    own = d[np.arange(len(d)), best]
    if d.shape[1] > 1:
        second = np.array([sorted(r)[1] for r in d], dtype=object) if d.dtype == object else np.partition(d, 1, axis=1)[:, 1]
        gap = np.sqrt(second.astype(float)) - np.sqrt(own.astype(float))
    else:
        gap = np.full(len(d), np.inf)
    return best, own, gap + offsets[best]


def assign_round(state: DataFrame, centroids: list[list[int]], offsets: list[float]) -> DataFrame:
    """One assignment: expired vectors (or never scanned ones) are rescanned, the rest keep cluster and key."""
    c = np.array(centroids, dtype=object)
    c = c.astype(np.int64) if np.abs(c).max() < EXACT_INT64 else c
    off = np.array(offsets, dtype=float)
    schema = T.StructType([
        T.StructField("vec_id", state.schema["vec_id"].dataType), T.StructField("point", T.ArrayType(T.LongType())),
        T.StructField("cluster", T.IntegerType()), T.StructField("key", T.DoubleType()), T.StructField("before", T.IntegerType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            cluster = batch.column(2).to_numpy(zero_copy_only=False)
            cluster = np.where(np.isnan(cluster.astype(float)), -1, cluster).astype(np.int64)
            key = batch.column(3).to_numpy(zero_copy_only=False).astype(float)
            limit = np.where(cluster >= 0, off[np.maximum(cluster, 0)], np.inf)
            expired = (cluster < 0) | ~(key - limit > SLACK * (1.0 + np.abs(key) + np.abs(limit)))
            new_cluster, new_key = cluster.copy(), key.copy()
            todo = np.flatnonzero(expired)
            if len(todo):
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                points = flat.reshape(n, -1)
                for s in range(0, len(todo), CHUNK):
                    part = todo[s:s + CHUNK]
                    best, _, k = rescan(points[part], c, off)
                    new_cluster[part], new_key[part] = best, k
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(new_cluster, pa.int32()), pa.array(new_key, pa.float64()),
                pa.array(np.where(cluster < 0, None, cluster).tolist(), pa.int32()),
            ], names=schema.names)

    return state.mapInArrow(run, schema)


def move_sums(state: DataFrame, dim: int) -> dict[int, tuple[list[int], int]]:
    """Per cluster: sum of points and count of the vectors that entered it minus those that left it (k rows)."""
    moved = state.where(F.col("before").isNull() | (F.col("before") != F.col("cluster")))
    signed = moved.select(F.explode(F.array(
        F.struct(F.col("cluster").alias("c"), F.lit(1).alias("s"), "point"),
        F.struct(F.col("before").alias("c"), F.lit(-1).alias("s"), "point"),
    )).alias("m")).where(F.col("m.c").isNotNull())
    sums = signed.groupBy(F.col("m.c").alias("c")).agg(
        F.sum("m.s").alias("n"), *[F.sum(F.col("m.point")[i].cast("decimal(38,0)") * F.col("m.s")).alias(f"s{i}") for i in range(dim)])
    return {r["c"]: ([int(r[f"s{i}"]) for i in range(dim)], int(r["n"])) for r in sums.collect()}


def cluster(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
            dim: int = DIM, scale: int = SCALE, prefix: str = SEED_PREFIX) -> DataFrame:
    """Lloyd's ``rounds`` rounds from the seed vectors, then a last assignment.

    Returns vec_id, cluster int, distance long (exact squared), cluster_inertia and inertia long, centroid_sha256
    (sha256 of the final centroid's components as decimal integers joined by ``,``).
    """
    points = kept_points(vectors, vec_id, vector, dim, scale)
    centroids = seeds(points, k, prefix)
    if not centroids:
        return points.select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"),
                             F.lit(None).cast("long").alias("cluster_inertia"), F.lit(None).cast("long").alias("inertia"),
                             F.lit(None).cast("string").alias("centroid_sha256")).limit(0)
    k = len(centroids)
    state = points.select("vec_id", "point", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("double").alias("key"))
    offsets = [0.0] * k
    sums: dict[int, list[int]] = {j: [0] * dim for j in range(k)}
    counts = {j: 0 for j in range(k)}
    for step in range(rounds + 1):
        state = cut_lineage(assign_round(state, centroids, offsets).sortWithinPartitions("cluster", "key"))
        if step == rounds:
            break
        for j, (s, n) in move_sums(state, dim).items():
            sums[j] = [a + b for a, b in zip(sums[j], s)]
            counts[j] += n
        moved = [[a // counts[j] for a in sums[j]] if counts[j] else centroids[j] for j in range(k)]
        drift = [math.sqrt(sum((a - b) ** 2 for a, b in zip(moved[j], centroids[j]))) for j in range(k)]
        top = sorted(range(k), key=lambda j: -drift[j])
        for j in range(k):
            other = drift[top[0]] if top[0] != j else (drift[top[1]] if k > 1 else 0.0)
            offsets[j] += drift[j] + other
        centroids = moved
        state = state.select("vec_id", "point", "cluster", "key")
    digests = [hashlib.sha256(",".join(str(x) for x in c).encode()).hexdigest() for c in centroids]
    table = F.array(*[F.array(*[F.lit(x).cast("long") for x in c]) for c in centroids])
    own = F.element_at(table, F.col("cluster") + 1)
    scored = cut_lineage(state.select("vec_id", "cluster", F.aggregate(
        F.zip_with("point", own, lambda a, b: ((a.cast(WIDE) - b.cast(WIDE)) * (a.cast(WIDE) - b.cast(WIDE))).cast(WIDE)),
        F.lit(0).cast(WIDE), lambda acc, x: (acc + x).cast(WIDE)).alias("distance")))
    per = {r["cluster"]: int(r["s"]) for r in scored.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    inertia = F.create_map(*[x for j in sorted(per) for x in (F.lit(j), F.lit(per[j]).cast("long"))])
    return scored.select(
        "vec_id", "cluster", F.col("distance").cast("long").alias("distance"), F.element_at(inertia, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(per.values())).cast("long").alias("inertia"), F.element_at(F.array(*[F.lit(d) for d in digests]), F.col("cluster") + 1).alias("centroid_sha256"))

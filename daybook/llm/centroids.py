"""Lloyd clustering of integer vectors, with Ptolemaic lower bounds in place of most distances.

For a vector x, a centroid c and two pivots p, s, Ptolemy's inequality gives

    d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s).

The distances of every vector to the pivots are computed once and kept beside it; those of the
centroids follow in every round. A centroid whose largest bound over the fixed pivot pairs lies
above the best distance so far is out; the others are checked exactly, in whole numbers. The
bounds are rounded down by more than what floating point can add, so nothing nearest is lost,
and ties, which survive, go to the smaller number.

Vectors are written once in packed blocks. A round is one scan: every task sums its vectors by
cluster, Spark adds the tasks' sums, and only the k new centroids come to the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import materialize, session_of

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
PIVOTS = 8
# Pivots are chosen far apart among so many vectors, the first by a hash of their own.
PIVOT_CANDIDATES = 256
BLOCK_ROWS = 4096
# Components beyond this count as it: squared distances of 64 of them still fit a long.
LIMIT = 1 << 27

_BLOCK = "ids array<long>, body binary, pivots binary"


def finite(vector: Column) -> Column:
    """True where a vector has neither null nor non-finite components; null for a null vector."""
    return ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))


def scaled(vector: Column, scale: int, limit: int = LIMIT) -> Column:
    """floor(scale * x) of each component, x as double, held to the limit."""
    return F.transform(vector.cast("array<double>"), lambda x: F.greatest(
        F.lit(-limit), F.least(F.lit(limit), F.floor(F.lit(float(scale)) * x))).cast("long"))


def first_by_hash(vectors: DataFrame, n: int, prefix: str, dims: int) -> np.ndarray:
    """The ``n`` vectors of smallest sha256 of ``<prefix>:<vec_id>`` (a null id as empty text)."""
    name = F.concat(F.lit(f"{prefix}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(F.encode(name, "UTF-8"), 256), "vec_id", "vector").limit(n).collect()
    return np.array([r["vector"] for r in rows], np.int64).reshape(len(rows), dims)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to the vector ``b``, or row by row."""
    diff = a.astype(np.int64) - b
    return np.einsum("ij,ij->i", diff, diff)


def choose_pivots(candidates: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Up to ``n`` different vectors, each farthest from those before it."""
    chosen = list(candidates[:1])
    if chosen:
        least = squared(candidates, chosen[0])
        while len(chosen) < n and least.max() > 0:
            chosen.append(candidates[int(least.argmax())])
            least = np.minimum(least, squared(candidates, chosen[-1]))
    return np.array(chosen, np.int64).reshape(len(chosen), candidates.shape[1])


def pivot_pairs(pivots: np.ndarray) -> np.ndarray:
    """The fixed pairs: each pivot with the next, around the ring."""
    n = len(pivots)
    return np.array([(i, (i + 1) % n) for i in range(n if n > 2 else n - 1)], np.int64).reshape(-1, 2)


def pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.array([squared(vectors, p) for p in pivots], np.float64)
                   .reshape(len(pivots), len(vectors)).T)


def lower_bounds(of_rows: np.ndarray, of_centroids: np.ndarray, pivots: np.ndarray,
                 pairs: np.ndarray) -> np.ndarray:
    """Squared lower bounds (row, centroid) by Ptolemy's inequality, rounded down.

    A cached distance is off by 2^-52 of itself at most, so the difference of two products is
    off by less than 2^-49 of their sum; that much is taken off, and 2^-47 of the square.
    """
    best = np.zeros((len(of_rows), len(of_centroids)))
    for p, s in pairs:
        apart = math.sqrt(int(squared(pivots[p:p + 1], pivots[s])[0]))
        x = np.outer(of_rows[:, p], of_centroids[:, s])
        y = np.outer(of_rows[:, s], of_centroids[:, p])
        low = (np.abs(x - y) - (x + y) * 2.0 ** -49) / apart
        np.maximum(best, low, out=best)
    return best * best * (1 - 2.0 ** -47)


def assign(rows: np.ndarray, of_rows: np.ndarray, centroids: np.ndarray, pivots: np.ndarray,
           pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and exact squared distance of each row; distances computed in all."""
    low = lower_bounds(of_rows, pivot_distances(centroids, pivots), pivots, pairs)
    near = low.argmin(1)
    best, checked = squared(rows, centroids[near]), len(rows)
    first = near.copy()
    for k in range(len(centroids)):
        left = np.flatnonzero((low[:, k] <= best) & (first != k))
        if len(left):
            d = squared(rows[left], centroids[k])
            checked += len(left)
            wins = (d < best[left]) | ((d == best[left]) & (k < near[left]))
            best[left[wins]], near[left[wins]] = d[wins], k
    return near, best, checked


def _unpack(row: dict, dims: int, n_pivots: int) -> tuple[list, np.ndarray, np.ndarray]:
    return (row["ids"], np.frombuffer(row["body"], "<i4").reshape(-1, dims),
            np.frombuffer(row["pivots"], "<f8").reshape(-1, n_pivots))


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def write_blocks(vectors: DataFrame, pivots: np.ndarray, dims: int) -> DataFrame:
    """The vectors with their pivot distances, packed, written and read back."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0

        def block() -> pa.RecordBatch:
            body = np.concatenate(parts)
            return pa.RecordBatch.from_pydict({
                "ids": pa.array([ids], pa.list_(pa.int64())), "body": [body.astype("<i4").tobytes()],
                "pivots": [pivot_distances(body, pivots).astype("<f8").tobytes()]})

        for batch in batches:
            values = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            ids += batch.column("vec_id").to_pylist()
            parts.append(values.reshape(-1, dims))
            held += batch.num_rows
            if held >= BLOCK_ROWS:
                yield block()
                ids, parts, held = [], [], 0
        if held:
            yield block()

    return materialize(vectors.mapInArrow(pack, _BLOCK), "vector-blocks")


def _new_centroids(blocks: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: the floor of each cluster's mean; an empty cluster stays where it is."""
    pairs, dims = pivot_pairs(pivots), centroids.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(centroids), dims + 1), np.int64)
        for row in _blocks_of(batches):
            _, body, cached = _unpack(row, dims, len(pivots))
            near, _, _ = assign(body, cached, centroids, pivots, pairs)
            for k in np.unique(near):
                mine = body[near == k]
                totals[k, :dims] += mine.sum(0, dtype=np.int64)
                totals[k, dims] += len(mine)
        k, dim = np.nonzero(totals[:, dims:] > 0)[0].repeat(dims + 1), None
        dim = np.tile(np.arange(dims + 1), len(k) // (dims + 1))
        yield pa.RecordBatch.from_pydict({"k": pa.array(k, pa.int32()), "dim": pa.array(dim, pa.int32()),
                                          "total": pa.array(totals[k, dim], pa.int64())})

    added = (blocks.mapInArrow(sums, "k int, dim int, total long").groupBy("k", "dim")
             .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    found = {(r["k"], r["dim"]): int(r["total"]) for r in added}  # k * (dims + 1) numbers at most
    return np.array([[found[k, d] // found[k, dims] if (k, dims) in found else int(old[d])
                      for d in range(dims)] for k, old in enumerate(centroids)], np.int64)


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS,
            scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    ``vectors`` needs ``vec_id`` and ``embedding``; other columns are ignored. Vectors of
    another length than ``dims``, null ones and those with a null or non-finite component are
    left out. Repeated ids and rows count each; a null id is kept. With fewer than ``k`` kept
    vectors each starts a cluster; without any the result is empty. Components beyond ±2^27
    after scaling count as that bound; a sum beyond a long comes out as null.
    """
    spark = session_of(vectors)
    column = F.col("embedding").cast("array<double>")
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), column.alias("vector")).where(
        (F.size("vector") == dims) & finite(F.col("vector")))
    kept = kept.select("vec_id", scaled(F.col("vector"), scale).alias("vector"))
    centroids = first_by_hash(kept, k, str(seed), dims)
    pivots = choose_pivots(first_by_hash(kept, PIVOT_CANDIDATES, f"pivot-{seed}", dims))
    out = "vec_id long, cluster int, distance long"
    if not len(centroids):
        assigned, by_cluster = spark.createDataFrame([], out), {}
    else:
        blocks = write_blocks(kept, pivots, dims)
        for _ in range(rounds):
            moved = _new_centroids(blocks, centroids, pivots)
            if (moved == centroids).all():  # later rounds would change nothing
                break
            centroids = moved
        pairs = pivot_pairs(pivots)

        def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _blocks_of(batches):
                ids, body, cached = _unpack(row, dims, len(pivots))
                near, best, _ = assign(body, cached, centroids, pivots, pairs)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": pa.array(ids, pa.int64()), "cluster": pa.array(near, pa.int32()),
                    "distance": pa.array(best, pa.int64())})

        assigned = materialize(blocks.mapInArrow(label, out), "clustered")
        by_cluster = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(
            F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # k rows
    as_long = lambda n: n if n < 1 << 63 else None
    rows = [(c, as_long(total), as_long(sum(by_cluster.values())), centroid_hash(centroids[c]))
            for c, total in by_cluster.items()]
    totals = spark.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def centroid_hash(centroid) -> str:
    """sha256 of the components in decimal, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()

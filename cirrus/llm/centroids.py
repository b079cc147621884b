"""Centroid clustering (Lloyd's rounds) in exact integers, with a pivot table.

The distances of every vector to a few fixed pivots are computed once and
stored with it (LAESA).  In each round, |d(x, p) - d(c, p)| over the pivots p
bounds the distance of vector x to centroid c from below; only centroids whose
bound doesn't pass the nearest one found so far get an exact distance, which
is an integer.  Bounds are rounded down, so that the result is that of a full
search.

Rounds pass only the centroids (k vectors) and their sums through the driver;
sums and counts are added up in the tasks first, then by position.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import bounded_batches, stored
from cirrus.llm.topk import scaled

#: Fixed points that every vector's distances are stored to.
PIVOTS = 16
#: Components up to here have squared distances that fit a long.
MOST = 1 << 27

_TABLE = "vec_id long, v array<int>, near array<double>"


def clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, by: int = 256, seed: str = "2", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of
    every vector of ``dims`` components, none of them null or non-finite.

    Components become floor(by * x).  The first centroids are the ``k``
    vectors with the smallest sha256 of ``<seed>:<id>`` (vectors without id
    after the others, ties by their components), all vectors if there are
    fewer; each of ``rounds`` rounds replaces every non-empty one by the floor of its
    vectors' mean.  Ties go to the smaller number.  Other vectors, and null
    ones, take no part; repeated rows and rows without id count each by
    themselves; other columns are ignored; an empty table gives no rows.
    Integers beyond 2^27 raise an error, as distances may not fit a long.
    """
    bounded_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col), by).alias("v")).where(F.size("v") == dims)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        none = rows.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))]).where("false")
        return none.withColumnRenamed("vec_id", id_col)
    pivots = far_apart(centroids, PIVOTS)
    table = stored(rows.mapInArrow(_near(pivots), _TABLE), "pivot-table")
    for _ in range(rounds):
        centroids = moved(table, centroids, pivots)
    found = stored(table.mapInArrow(_assigned(centroids, pivots), "vec_id long, cluster int, distance long"), "assigned")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    of = lambda values: F.element_at(F.array(*[F.lit(x) for x in values]), F.col("cluster") + 1)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return found.select(
        F.col("vec_id").alias(id_col),
        "cluster",
        "distance",
        of([sums.get(j, 0) for j in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        of(digests).alias("centroid_sha256"),
    )


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    ranked = rows.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    return np.array([r["v"] for r in ranked.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()], np.int64)


def far_apart(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the points (all, if fewer), each the farthest from those
    before it."""
    x = points.astype(float)
    picked = [int(((x - x.mean(0)) ** 2).sum(1).argmax())]
    least = ((x - x[picked[0]]) ** 2).sum(1)
    while len(picked) < min(n, len(x)):
        picked.append(int(least.argmax()))
        least = np.minimum(least, ((x - x[picked[-1]]) ** 2).sum(1))
    return points[picked]


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round; empty ones stay."""
    sums = table.mapInArrow(_summed(centroids, pivots), "cluster int, n long, sums array<long>")
    at = sums.select("cluster", "n", F.posexplode("sums").alias("i", "s")).groupBy("cluster", "i")
    total = at.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = centroids.copy()
    for r in total.collect():
        out[r["cluster"], r["i"]] = int(r["s"]) // r["n"]
    return out


def nearest(x: np.ndarray, near: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of and squared distance to the nearest centroid of every row of
    ``x``, whose distances to the pivots are ``near``; and how many exact
    distances that took."""
    to = np.sqrt(((centroids[:, None, :] - pivots[None]) ** 2).sum(2).astype(float))
    low = np.zeros((len(x), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(low, np.abs(near[:, p, None] - to[None, :, p]), out=low)
    # what rounding may have added to the bounds, taken off
    low = np.maximum(low - 1e-12 * (near.max(1)[:, None] + to.max(1)[None]), 0) ** 2 * (1 - 1e-12)
    order = np.argsort(low, axis=1, kind="stable")
    rows = np.arange(len(x))
    cluster = order[:, 0].copy()
    best = ((x - centroids[cluster]) ** 2).sum(1)
    exact = len(x)
    for k in range(1, len(centroids)):
        rows = rows[low[rows, order[rows, k]] <= best[rows]]
        if not len(rows):
            break
        other = order[rows, k]
        d = ((x[rows] - centroids[other]) ** 2).sum(1)
        exact += len(rows)
        better = (d < best[rows]) | (d == best[rows]) & (other < cluster[rows])
        best[rows[better]], cluster[rows[better]] = d[better], other[better]
    return cluster, best, exact


#: Vectors that a task looks at together.
_AT_ONCE = 4096


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    flat = np.asarray(column.flatten()).astype(dtype, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _near(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), np.int64)
            if np.abs(x).max(initial=0) > MOST:
                raise ValueError(f"components beyond {MOST}: their distances may not fit a long")
            if not len(x):
                continue
            near = np.sqrt(np.stack([((x - p) ** 2).sum(1) for p in pivots], axis=1).astype(float))
            lists = lambda m, t: pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), pa.array(m.ravel(), t))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(x, pa.int32()), lists(near, pa.float64())], names=["vec_id", "v", "near"])

    return run


def _searched(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for whole in batches:
        for a in range(0, whole.num_rows, _AT_ONCE):
            batch = whole.slice(a, _AT_ONCE)
            x = _matrix(batch.column(1), np.int64)
            cluster, distance, _ = nearest(x, _matrix(batch.column(2), float), centroids, pivots)
            yield batch, x, cluster, distance


def _assigned(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, cluster, distance in _searched(batches, centroids, pivots):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return run


def _summed(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(centroids), np.int64), np.zeros_like(centroids)
        for _, x, cluster, _ in _searched(batches, centroids, pivots):
            n += np.bincount(cluster, minlength=len(n))
            np.add.at(sums, cluster, x)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    return run

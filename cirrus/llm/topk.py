"""Exact top-k by inner product: a ball tree per shard, branch and bound.

Candidates are dealt into shards by hash, queries into blocks.  A task holds
one shard and one block: it builds the shard's ball tree and searches it for
the whole block at once, nodes in order of their inner-product upper bound
(query . centre + |query| * radius), each query leaving a node out as soon as
its kth score so far is above the bound.  The first shard is searched alone;
its kth scores go with the queries to all other shards, so that these prune,
and hand on, only what can still enter the result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cirrus.llm.common import bounded_batches, stored

SHARD_ROWS, BLOCK_QUERIES, LEAF_ROWS = 8192, 2048, 256
_HITS = "query_id long, vec_id long, score long"


def scaled(vector: Column, by: int) -> Column:
    """floor(by * x) of every component, x as double; null for a vector that
    is null, empty, or holds null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    whole = F.transform(vector, lambda x: F.floor(F.lit(by) * x.cast("double")))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad), whole)


def top_k(vectors: DataFrame, is_query: Column, k: int, by: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): every query's ``k`` highest inner
    products with the other rows, ties to the smaller id; all if fewer.

    Vectors are the integers of :func:`scaled`; those without value, and rows
    without id, take no part.  Only vectors of one length are compared.  Rows
    that share an id count as one vector each, none of which is a candidate
    for a query of that id; repeated query rows (same id and vector) are one
    query.  Other columns are ignored.  Scores are exact while they fit a
    long.  An empty table, or one without queries, gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col), by).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    bounded_batches(vectors.sparkSession)
    # dealt by row, as many rows may share an id
    rows = rows.where("vec_id IS NOT NULL AND v IS NOT NULL").withColumn("deal", F.xxhash64(F.monotonically_increasing_id(), F.lit(1)))
    rows = stored(rows, "vectors")
    n, nq = rows.count(), rows.where("q").count()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-nq // BLOCK_QUERIES))
    dealt = rows.withColumn("shard", F.pmod("deal", F.lit(shards)).cast("int"))
    queries = rows.where("q").groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("_n")).select(F.col("vec_id").alias("query_id"), "v")
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(2)), F.lit(blocks)).cast("int"))
    cands = dealt.select("vec_id", "v", "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    first = stored(_searched(queries.withColumn("shard", F.lit(0)).withColumn("least", F.lit(None).cast("long")), cands.where("shard = 0"), k), "top-first")
    if shards == 1:
        return _ranked(first, k)
    kth = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k)
    bounded = queries.join(kth.select(F.col("query_id").alias("_q"), "least"), F.col("query_id") == F.col("_q"), "left").drop("_q")
    bounded = bounded.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards - 1))))
    others = _searched(bounded, cands.where("shard > 0"), k)
    return _ranked(first.unionByName(others), k)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _searched(queries: DataFrame, cands: DataFrame, k: int) -> DataFrame:
    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")]
        for size in set(q["v"].map(len)) if len(c) else ():
            qs, cs = q[q["v"].map(len) == size], c[c["v"].map(len) == size]
            if len(cs):
                least = qs["least"].to_numpy(dtype=object)
                out.append(_search(qs["query_id"].to_numpy(np.int64), np.stack(qs["v"]).astype(np.int64), least, cs["vec_id"].to_numpy(np.int64), np.stack(cs["v"]).astype(np.int64), k))
        return pd.concat(out, ignore_index=True)

    # both sides come of one table: names of their own keep their columns apart
    own = lambda df, *cols: df.select(*[F.col(c).alias(c) for c in cols], F.col("shard").alias("_shard"), F.col("block").alias("_block"))
    queries, cands = own(queries, "query_id", "v", "least"), own(cands, "vec_id", "v")
    return queries.groupBy("_shard", "_block").cogroup(cands.groupBy("_shard", "_block")).applyInPandas(lambda q, c: search(q, c), _HITS)


class BallTree:
    """Rows of each leaf, centres and radii of all nodes; node i has the
    children 2i + 1 and 2i + 2, the leaves are the last level."""

    def __init__(self, x: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.depth = max(0, int(np.ceil(np.log2(max(1, len(x) / leaf_rows)))))
        groups = [np.arange(len(x))]
        centres, radii = [], []
        for level in range(self.depth + 1):
            for g in groups:
                centre = x[g].mean(0) if len(g) else np.zeros(x.shape[1])
                centres.append(centre)
                radii.append(float(np.sqrt(((x[g] - centre) ** 2).sum(1).max())) if len(g) else -1.0)
            if level < self.depth:
                groups = [half for g in groups for half in _halves(x, g)]
        self.centres, self.radii, self.leaves = np.array(centres), np.array(radii), groups


def _halves(x: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Along the line between two far rows, at the median."""
    if len(rows) < 2:
        return rows, rows[:0]
    one = x[rows[((x[rows] - x[rows[0]]) ** 2).sum(1).argmax()]]
    two = x[rows[((x[rows] - one) ** 2).sum(1).argmax()]]
    order = np.argsort(x[rows] @ (two - one), kind="stable")
    half = len(rows) // 2
    return rows[order[:half]], rows[order[half:]]


def _search(qid: np.ndarray, q: np.ndarray, least: np.ndarray, vid: np.ndarray, v: np.ndarray, k: int) -> pd.DataFrame:
    order = np.argsort(vid, kind="stable")  # positions then break ties by id
    vid, v = vid[order], v[order]
    size = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1]
    exact = size < 2.0**52  # then sums of products are exact in doubles
    qf, vf = q.astype(float), v.astype(float)
    tree = BallTree(vf)
    norms = np.sqrt((qf**2).sum(1))
    slack = 1e-9 * (1 + size)  # for the rounding of bounds
    best = np.full((len(q), k), -1, np.int64)  # positions
    scores = np.full((len(q), k), np.iinfo(np.int64).min)
    floor = np.array([np.iinfo(np.int64).min if pd.isna(x) else int(x) for x in least])

    def bound(node: int, rows: np.ndarray) -> np.ndarray:
        return qf[rows] @ tree.centres[node] + norms[rows] * tree.radii[node] + slack

    def kth(rows: np.ndarray) -> np.ndarray:
        return np.maximum(floor[rows], scores[rows, -1])

    def leaf(number: int, rows: np.ndarray) -> None:
        at = tree.leaves[number]
        if not len(at):
            return
        got = np.rint(qf[rows] @ vf[at].T).astype(np.int64) if exact else q[rows] @ v[at].T
        can = got >= kth(rows)[:, None]
        can &= vid[at][None, :] != qid[rows][:, None]
        some = np.flatnonzero(can.any(1))
        rows, got, can = rows[some], got[some], can[some]
        got = np.where(can, got, np.iinfo(np.int64).min)
        where = np.where(can, at[None, :], -1)
        if got.shape[1] > k:  # the k highest with all that tie with the last
            cut = np.partition(got, -k, axis=1)[:, -k]
            wide = int((got >= cut[:, None]).sum(1).max(initial=0))
            if wide < got.shape[1]:
                pick = np.argpartition(np.where(got >= cut[:, None], 0, 1), wide - 1, axis=1)[:, :wide]
                got, where = np.take_along_axis(got, pick, 1), np.take_along_axis(where, pick, 1)
        got = np.concatenate([scores[rows], got], axis=1)
        where = np.concatenate([best[rows], where], axis=1)
        sort = np.lexsort((where, -np.maximum(got, -np.iinfo(np.int64).max)), axis=1)[:, :k]
        scores[rows], best[rows] = np.take_along_axis(got, sort, 1), np.take_along_axis(where, sort, 1)

    # nodes wait with the rows that have to see them; the one with the highest
    # bound of any of its rows is next
    inner = 2**tree.depth - 1
    waiting = [(float("inf"), 0, np.arange(len(q)))]
    while waiting:
        top = max(range(len(waiting)), key=lambda i: waiting[i][0])
        _, node, rows = waiting.pop(top)
        rows = rows[bound(node, rows) >= kth(rows)]
        if not len(rows):
            continue
        if node >= inner:
            leaf(node - inner, rows)
        else:
            for child in (2 * node + 1, 2 * node + 2):
                waiting.append((float(bound(child, rows).max()), child, rows))
    hit = best >= 0
    return pd.DataFrame({"query_id": np.repeat(qid, hit.sum(1)), "vec_id": vid[best[hit]], "score": scores[hit]})

"""Nearest neighbours by vantage-point trees, one for each shard.

The rows are dealt to shards by a hash of their id, so equal vectors and
clusters spread evenly. Each shard meets the queries in blocks: a task
builds the shard's tree and searches it for a block of queries at a time,
then the best of all shards are merged for each query.

A node of the tree splits its vectors at the median distance ``m`` to its
vantage point. For a query at distance ``d`` whose k-th best is at ``r``, the
triangle inequality says that the far side holds nothing better if
``|d - m| > r``. ``factor`` relaxes this: the far side is skipped if
``|d - m| > factor * r``. Factor 1 is exact search; a smaller one visits less
and may miss neighbours.

Results for odd input: rows without id, and vectors that are null, empty, all zero
or hold null or non-finite components, take no part, as query or as candidate;
vectors of different length are not compared; ties go to the smaller id;
rows that share the query's id are not its candidates; of queries with one id
the least vector counts; a repeated candidate row is found each time; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LEAF = 64
#: Candidates in a shard and queries in a block, on average; they bound a task's memory.
SHARD_ROWS = 20_000
BLOCK_QUERIES = 2_000


class Tree:
    """Vantage-point tree over the rows of ``x`` (ids ``ids``)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.root = self._build(np.arange(len(ids)))

    def _distances(self, rows: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances of points (n, dim) to rows: (n, len(rows)), in double, component by component."""
        out = np.empty((len(points), len(rows)))
        y = self.x[rows]
        step = max(1, 2_000_000 // max(1, y.size))
        for at in range(0, len(points), step):
            d = points[at: at + step, None, :] - y[None, :, :]
            out[at: at + step] = np.sqrt(np.einsum("ijk,ijk->ij", d, d))
        return out

    def _build(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        vantage, rest = rows[:1], rows[1:]
        d = self._distances(rest, self.x[vantage])[0]
        m = float(np.median(d))
        inner = d <= m
        if inner.all():  # as many equal distances as there are rows
            return rows
        return vantage, m, self._build(rest[inner]), self._build(rest[~inner])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest of each query, nearest first
        (an infinite distance where there are fewer)."""
        self.q_ids, self.q, self.k, self.factor = query_ids, queries, k, factor
        self.best_d = np.full((len(queries), k), np.inf)
        self.best_i = np.full((len(queries), k), np.iinfo(np.int64).max)
        self._visit(self.root, np.arange(len(queries)))
        return self.best_i, self.best_d

    def _offer(self, active: np.ndarray, rows: np.ndarray, d: np.ndarray) -> None:
        d = np.where(self.ids[rows][None, :] == self.q_ids[active][:, None], np.inf, d)
        worth = np.flatnonzero(d.min(axis=1) <= self.best_d[active, -1])
        if not len(worth):
            return
        who = active[worth]
        all_d = np.concatenate([self.best_d[who], d[worth]], axis=1)
        all_i = np.concatenate([self.best_i[who], np.broadcast_to(self.ids[rows], (len(who), len(rows)))], axis=1)
        all_i = np.where(np.isinf(all_d), np.iinfo(np.int64).max, all_i)
        pick = np.lexsort((all_i, all_d), axis=1)[:, : self.k]
        self.best_d[who] = np.take_along_axis(all_d, pick, axis=1)
        self.best_i[who] = np.take_along_axis(all_i, pick, axis=1)

    def _visit(self, node, active: np.ndarray) -> None:
        if not len(active):
            return
        if isinstance(node, np.ndarray):
            if len(node):
                for at in range(0, len(node), 4 * LEAF):  # a leaf of equal distances can be long
                    rows = node[at: at + 4 * LEAF]
                    self._offer(active, rows, self._distances(rows, self.q[active]))
            return
        vantage, m, inner, outer = node
        d = self._distances(vantage, self.q[active])
        self._offer(active, vantage, d)
        d = d[:, 0]
        near_inner = d <= m
        for near, far, side in ((inner, outer, near_inner), (outer, inner, ~near_inner)):
            who, gap = active[side], np.abs(d[side] - m)
            self._visit(near, who)
            # a hair more than the bound, so that rounding never cuts a tie
            self._visit(far, who[gap <= self.factor * self.best_d[who, -1] * (1 + 1e-9) + 1e-12])


def usable(vector: Column) -> Column:
    """Neither null, nor empty, nor all zero, with finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (Euclidean
    distance) of the k nearest rows of ``vectors`` to each row of ``queries``
    (same columns). Actions: two counts, which set the numbers of shards and blocks."""
    def clean(df):
        d = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
        return d.where(F.col("id").isNotNull() & usable(F.col("v")))

    rows = clean(vectors)
    asked = clean(queries).groupBy("id").agg(F.min("v").alias("v"))
    spark = vectors.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(least, math.ceil(rows.count() / SHARD_ROWS))
    blocks = max(1, math.ceil(asked.count() / BLOCK_QUERIES))
    salt = F.xxhash64(F.lit(7), "id")
    block = F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("id", "v", F.size("v").alias("dim"), F.pmod(salt, F.lit(shards)).cast("int").alias("shard"),
                       every(blocks).alias("block"))
    right = asked.select("id", "v", F.size("v").alias("dim"), every(shards).alias("shard"), block.alias("block"))
    keys = ["shard", "block", "dim"]

    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        v = t.column("v").combine_chunks()
        return t.column("id").to_numpy(), v.flatten().to_numpy().reshape(t.num_rows, -1)

    def search(rows_in: pa.Table, asked_in: pa.Table) -> pa.Table:
        if not rows_in.num_rows or not asked_in.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        q_ids, q = matrix(asked_in)
        ids, d = Tree(*matrix(rows_in)).search(q_ids, q, k, factor)
        found = np.isfinite(d)
        return pa.table({"query_id": np.repeat(q_ids, k)[found.ravel()], "vec_id": ids.ravel()[found.ravel()],
                         "score": d.ravel()[found.ravel()]})

    local = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return local.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Exact top-k search by inner product over a KD-tree per shard.

Vectors are dealt over shards of bounded size.  Each shard builds one tree: median
splits along the widest axis, with the tight box of every node.  A box bounds the
inner product of a query with everything in it, so a best-first traversal stops at
the first box that can't reach the k-th best score.  That score is propagated: a
first pass over one small shard gives every query a k-th score to start from.

Rows: vectors that are null, or hold null or non-finite components, take no part as
candidates or queries, nor do rows with a null id.  Vectors are compared with those of
their own length only; empty ones score 0 with one another.  A query is not its own
candidate; repeated ids are one another's own.  Each row is a candidate of its own, so
repeated rows take several ranks; the vectors of a repeated query id share its ranks.
Ties go to the smaller id.  A query with no candidate has no row.  Products are summed
as whole numbers of any size; a component or score beyond 64 bits counts as the nearest
number that fits.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, ship

SHARD_ROWS = 8192
QUERY_BLOCK = 512
LEAF = 128


#: Whole numbers up to here are exact in doubles, and numbers that no score is below or above.
EXACT, LEAST, MOST = 1 << 53, -(2**63), 2**63 - 1


def _largest(points: np.ndarray) -> int:
    return max(abs(int(points.min(initial=0))), abs(int(points.max(initial=0))))


class KdTree:
    """Boxes of a balanced tree over integer points; leaves are runs of the reordered points."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, int, int]] = []  # first, last, left child, right child
        low, high = [], []

        def build(first: int, last: int) -> int:
            own = points[self.order[first:last]]
            a, b = own.min(axis=0), own.max(axis=0)
            k = len(self.nodes)
            self.nodes.append((first, last, -1, -1))
            low.append(a)
            high.append(b)
            if last - first > leaf and (b > a).any():
                axis, mid = int((b.astype(np.float64) - a).argmax()), (first + last) // 2
                self.order[first:last] = self.order[first:last][np.argpartition(own[:, axis], mid - first)]
                left = build(first, mid)
                self.nodes[k] = (first, last, left, build(mid, last))
            return k

        build(0, len(points))
        self.points, self.ids = points[self.order], ids[self.order]
        self.low, self.high, self.largest = np.array(low), np.array(high), _largest(points)

    def fit(self, queries: np.ndarray) -> np.ndarray:
        """The queries as numbers whose products with the points add up exactly: doubles, or else Python's integers."""
        safe = queries.shape[1] * self.largest * _largest(queries) < EXACT
        kind = np.float64 if safe and self.largest < EXACT and _largest(queries) < EXACT else object
        if self.points.dtype != kind:
            self.points, self.low, self.high = self.points.astype(kind), self.low.astype(kind), self.high.astype(kind)
        return queries.astype(kind)

    def _whole(self, sums: np.ndarray) -> np.ndarray:
        return (np.clip(sums, LEAST, MOST) if sums.dtype == object else sums).astype(np.int64)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """[query, node]: no point of the node's box scores higher."""
        return self._whole(np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T)

    def search(self, query: np.ndarray, own: int, bound: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """Up to k (score, id) of at least ``floor``, best first; ties to the smaller id."""
        best_score, best_id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        heap = [(-int(bound[0]), 0)]
        while heap:
            upper, node = heapq.heappop(heap)
            if -upper < floor:
                break
            first, last, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    if bound[child] >= floor:
                        heapq.heappush(heap, (-int(bound[child]), child))
                continue
            score = self._whole(self.points[first:last] @ query)
            take = (score >= floor) & (self.ids[first:last] != own)
            if take.any():
                best_score, best_id = np.append(best_score, score[take]), np.append(best_id, self.ids[first:last][take])
                by = np.lexsort((best_id, ~best_score))[:k]  # ~ falls as the score rises
                best_score, best_id = best_score[by], best_id[by]
                if len(by) == k:
                    floor = max(floor, int(best_score[-1]))
        return list(zip(best_score.tolist(), best_id.tolist()))


def _blocks(rows: DataFrame, group: list[str]) -> DataFrame:
    """One row for each group: ids, points and floors as arrays of bytes."""

    def pack(own):
        points = np.array(own["v"].tolist(), "<i8")
        return pd.DataFrame({g: [own[g].iloc[0]] for g in group} | {"ids": [own["id"].to_numpy(np.int64).tobytes()], "points": [points.tobytes()], "floors": [own["floor"].to_numpy(np.int64).tobytes()]})

    return rows.groupBy(*group).applyInPandas(pack, ", ".join(f"{g} long" for g in group) + ", ids binary, points binary, floors binary")


def _search(shards: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Every query block against every shard of its dimension: a shard's tree is built once and blocks stream by."""
    pairs = queries.join(shards.select("dim", "shard"), "dim")
    both = shards.select("dim", "shard", F.lit(0).alias("kind"), "ids", "points", "floors").unionByName(pairs.select("dim", "shard", F.lit(1).alias("kind"), "ids", "points", "floors"))

    def run(batches):
        tree, at = None, None
        for batch in batches:
            for row in batch.to_pylist():
                dim, key = row["dim"], (row["dim"], row["shard"])
                ids = np.frombuffer(row["ids"], np.int64)
                points = np.frombuffer(row["points"], "<i8").reshape(len(ids), dim)
                if row["kind"] == 0:
                    tree, at = KdTree(points, ids), key
                    continue
                assert at == key
                q = tree.fit(points)
                bounds, floors = tree.bounds(q), np.frombuffer(row["floors"], np.int64)
                out = [(int(own), s, c) for own, p, b, f in zip(ids, q, bounds, floors) for s, c in tree.search(p, int(own), b, k, int(f))]
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(3)], names=["query_id", "score", "vec_id"])

    shard_count = F.col("dim") * 1_000_003 + F.col("shard")
    return both.repartition(both.sparkSession.sparkContext.defaultParallelism * 4, shard_count).sortWithinPartitions("dim", "shard", "kind").mapInArrow(run, "query_id long, score long, vec_id long")


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of the components floor(scale * x)."""
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark, "topk")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    v = F.transform(vectors[vector_col], lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.where(vectors[id_col].isNotNull() & vectors[vector_col].isNotNull() & F.coalesce(F.forall(vectors[vector_col], finite), F.lit(False)))
    rows = rows.select(vectors[id_col].cast("long").alias("id"), v.alias("v"), is_query.alias("q"), F.size(vectors[vector_col]).cast("long").alias("dim"), F.lit(LEAST).cast("long").alias("floor"))
    sizes = scratch.save(rows.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("long").alias("shards")), "sizes")
    rows = rows.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("id"), "shards"))
    shards = scratch.save(_blocks(rows.select("dim", "shard", "id", "v", "floor"), ["dim", "shard"]), "shards")
    blocks = F.greatest(F.lit(1).cast("long"), F.floor(F.col("shards") * shard_rows / (50 * QUERY_BLOCK)).cast("long"))
    asked = scratch.save(rows.where("q").select("dim", "id", "v", "floor", F.pmod(F.xxhash64("id", F.lit(1)), blocks).alias("block")), "queries")
    packed = lambda rows: _blocks(rows.select("dim", "block", "id", "v", "floor"), ["dim", "block"])
    first = scratch.save(_ranked(_search(shards.where("shard = 0"), packed(asked), k), k), "first")
    floors = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    rest = _search(shards.where("shard > 0"), packed(asked.drop("floor").join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(LEAST).cast("long")))), k)
    return _ranked(first.select("query_id", "score", "vec_id").unionByName(rest), k).select("query_id", "rank", "vec_id", "score")

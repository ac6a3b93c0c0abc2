"""Exact top-k search by inner product with a KD-tree per shard.

Vectors are dealt to shards. A shard splits its vectors at the median of the widest component until a
leaf holds few, and keeps the tight box of every node. The largest inner product a query can have in a
box is `q+ . high + q- . low`; a query visits nodes best bound first and stops when the bound is below
its k-th best score. Each query is searched in its own shard first; the k-th score found there is
propagated to its search of all shards. The result is exact, ties to the smaller id.

Defined results: vectors that are null, empty or hold null or non-finite components take no part, nor
do rows without an id; zero vectors do; vectors of different length are not compared; a query is not
its own neighbour, and of rows with one id none is a neighbour of another (as a query, the smallest vector
stands for them); an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from . import blocks

FOUND = "query_id long, vec_id long, score double"
ROWS_PER_SHARD, QUERIES_PER_BLOCK, LEAF = 8192, 1024, 64


def grown_tree(ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Rows reordered so that every node is a run, and the nodes: first row, end, children, box.
    A median split by rank also divides equal vectors, so leaves stay small."""
    order = np.arange(len(ids))
    nodes: list[list] = []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        inside = matrix[order[start:end]]
        low, high = inside.min(axis=0), inside.max(axis=0)
        number = len(nodes)
        nodes.append([start, end, -1, -1, low, high])
        if parent >= 0:
            nodes[parent][2 + side] = number
        if end - start > LEAF:
            middle = (end - start) // 2
            order[start:end] = order[start:end][np.argpartition(inside[:, np.argmax(high - low)], middle)]
            todo += [(start, start + middle, number, 0), (start + middle, end, number, 1)]
    spans = np.array([n[:4] for n in nodes], np.int64)
    boxes = np.array([n[4] for n in nodes]), np.array([n[5] for n in nodes])
    return ids[order], matrix[order], pickle.dumps((spans, *boxes))


def tree_search(k: int):
    def search(queries, data) -> pd.DataFrame:
        (q_ids, q, known), (x_ids, x, tree) = queries, data
        floors = np.frombuffer(known, np.float64) if known else np.full(len(q_ids), -np.inf)
        spans, low, high = pickle.loads(tree)
        bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        # Rounding of a bound must not hide a row that reaches it.
        bounds += 1e-9 * (1 + np.abs(bounds))
        found = []
        for i, own in enumerate(q_ids.tolist()):
            heap: list[tuple] = []
            kth, bound = floors[i], bounds[i]
            front = [(-bound[0], 0)]
            while front:
                reach, node = heapq.heappop(front)
                if -reach < kth:
                    break
                start, end, left, right = spans[node]
                if left >= 0:
                    heapq.heappush(front, (-bound[left], int(left)))
                    heapq.heappush(front, (-bound[right], int(right)))
                    continue
                scores = x[start:end] @ q[i]
                for j in np.flatnonzero(scores >= kth - 1e-9 * (1 + abs(kth)) if np.isfinite(kth) else np.ones(len(scores), bool)):
                    ident = int(x_ids[start + j])
                    if ident == own:
                        continue
                    entry = (float(scores[j]), -ident)
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                if len(heap) == k:
                    kth = max(kth, heap[0][0])
            found += [(own, -n, s) for s, n in heap]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`query_id, rank, vec_id, score` (double) of the k largest inner products. Exact where all
    products are, as for whole numbers below 2^53; `is_query` is a condition on `_id`."""
    rows = blocks.usable(vectors, ident, vector, zero=True)
    total = rows.count()
    packed, shards = blocks.packed(rows, ROWS_PER_SHARD, grown_tree, total)
    data = written(packed, "trees")
    asked = blocks.asked(rows, is_query)
    # The same hash and number of blocks put a query into the block of its own shard.
    home, _ = blocks.packed(asked, ROWS_PER_SHARD, count=total)
    first = _own_shard(home, data, tree_search(k))
    kth = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"), F.min("score").alias("_low"))
    kth = kth.select(F.col("query_id").alias("_id"), F.when(F.col("_n") >= k, F.col("_low")).alias("_kth"))
    bound = F.coalesce("_kth", F.lit(float("-inf")))
    told = written(asked.join(kth, "_id", "left").withColumn("_bound", bound).drop("_kth"), "asked")
    queries, query_blocks = blocks.packed(told, QUERIES_PER_BLOCK)
    found = blocks.tiles(queries, query_blocks, data, shards, tree_search(k), FOUND)
    return blocks.best(found, k, "double")


def _own_shard(home: DataFrame, data: DataFrame, search) -> DataFrame:
    """Queries against the shard that holds them."""
    sides = home.withColumn("kind", F.lit(0)).union(data.withColumn("kind", F.lit(1)))

    def pair(frame: pd.DataFrame) -> pd.DataFrame:
        both = {r.kind: r for r in frame.itertuples(index=False)}
        if len(both) < 2:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return search(blocks.unpack(both[0]), blocks.unpack(both[1]))

    return sides.groupBy("dim", "block").applyInPandas(pair, FOUND)


def whole_numbers(vectors: DataFrame, vector: str = "embedding", factor: int = 256) -> DataFrame:
    """The vector with each component x as floor(factor * x), x as double; null and non-finite
    components stay as they are."""
    scaled = lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("double")
    finite = lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vectors.withColumn(vector, F.transform(F.col(vector), lambda x: F.when(finite(x), scaled(x)).otherwise(x.cast("double"))))

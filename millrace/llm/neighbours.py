"""Nearest neighbours by a block matrix join with int8 tiles.

Vectors are rounded to int8 with a scale of their own. The product of two int8 blocks is exact, and the
rounding errors of both sides bound how far it is from the true inner product:
`|q.x - sq sx qi.xi| <= |sq qi| |ex| + |eq| |x|` with the error vectors `eq`, `ex`. In each tile a
pair survives unless its upper bound is below the k-th best lower bound of its query; survivors are
recomputed in double precision on the original vectors and kept in a heap of k. The best of all tiles
are the answer, so nothing is lost to rounding.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part,
nor do rows without an id; vectors of different length are not compared; a query is not its own
neighbour, and of rows with one id none is a neighbour of another (as a query, the smallest vector
stands for them); equal scores go to the smaller id; a product beyond
the largest double is infinite, and a pair whose product is no number is left out;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame

from . import blocks

LARGEST = float(np.finfo(np.float64).max)
FOUND = "query_id long, vec_id long, score double"
QUERIES_PER_BLOCK, ROWS_PER_BLOCK, COLUMNS_AT_ONCE, PAIRS_AT_ONCE = 1024, 8192, 2048, 65536


def quantised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the lengths of the rounded rows and of what rounding lost."""
    scale = np.abs(matrix).max(axis=1) / 127.0
    scale = np.maximum(scale, np.finfo(np.float64).tiny)
    small = np.rint(matrix / scale[:, None]).clip(-127, 127).astype(np.int8)
    kept = small * scale[:, None]
    return small, scale, np.linalg.norm(kept, axis=1), np.linalg.norm(matrix - kept, axis=1)


def _powers(matrix: np.ndarray) -> np.ndarray:
    """The power of two above the largest entry of each row."""
    return np.frexp(np.abs(matrix).max(axis=1, initial=0))[1]


def tile_search(k: int):
    def search(queries, data) -> pd.DataFrame:
        (q_ids, q, _), (x_ids, x, _) = queries, data
        # Sums of up to 127 * 127 * dim are exact in the float type chosen.
        exact = np.float32 if q.shape[1] * 127 * 127 < 2**24 else np.float64
        # Bounds are found on rows scaled by powers of two, so that no product of finite rows overflows there.
        q_power, x_power = _powers(q), np.full(len(x), _powers(x).max(initial=0))
        qi, q_scale, q_kept, q_lost = quantised(np.ldexp(q, -q_power[:, None]))
        xi, x_scale, x_kept, x_lost = quantised(np.ldexp(x, -x_power[:, None]))
        down = -(q_power + x_power.max(initial=0))
        q_tile, slack = qi.astype(exact), 1e-9
        heaps: list[list] = [[] for _ in q_ids]
        floor = np.full(len(q_ids), -np.inf)
        for start in range(0, len(x_ids), COLUMNS_AT_ONCE):
            part = slice(start, start + COLUMNS_AT_ONCE)
            product = (q_tile @ xi[part].astype(exact).T).astype(np.float64)
            about = product * q_scale[:, None] * x_scale[None, part]
            error = q_kept[:, None] * x_lost[None, part] + q_lost[:, None] * (x_kept + x_lost)[None, part]
            error += slack * (1 + np.abs(about))
            other = q_ids[:, None] != x_ids[None, part]
            low = np.where(other, about - error, -np.inf)
            if low.shape[1] > k:
                floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
            rows, columns = np.nonzero((about + error >= floor[:, None]) & other)
            # Many equal vectors survive together, so survivors are worked off in pieces.
            for at in range(0, len(rows), PAIRS_AT_ONCE):
                r_part, c_part = rows[at : at + PAIRS_AT_ONCE], columns[at : at + PAIRS_AT_ONCE] + start
                scores = blocks.exact_products(q[r_part], x[c_part])
                for r, s, i in zip(r_part.tolist(), scores.tolist(), x_ids[c_part].tolist()):
                    if s != s:  # sums of infinite terms of both signs
                        continue
                    heap, entry = heaps[r], (s, -i)
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
            # A score beyond the largest double is no less than that.
            full = np.array([min(h[0][0], LARGEST) if len(h) == k else -np.inf for h in heaps])
            floor = np.maximum(floor, np.ldexp(full, down) - slack)
        found = [(int(i), -n, s) for i, heap in zip(q_ids, heaps) for s, n in heap]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return search


def nearest(vectors: DataFrame, is_query: Column, k: int, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`query_id, rank, vec_id, score` of the k nearest by inner product. `is_query` is a condition
    on `_id`."""
    rows = blocks.usable(vectors, ident, vector, zero=False)
    data, data_blocks = blocks.packed(rows, ROWS_PER_BLOCK)
    queries, query_blocks = blocks.packed(blocks.asked(rows, is_query), QUERIES_PER_BLOCK)
    found = blocks.tiles(queries, query_blocks, data, data_blocks, tile_search(k), FOUND)
    return blocks.best(found, k, "double")

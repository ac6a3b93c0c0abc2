"""Vectors packed into blocks, so that queries meet all rows block by block.

A block is one row: ids and a matrix as bytes. Both sides are dealt to blocks by a hash of the id, whose
number follows from their counts, so the size of a block is bounded in expectation whatever the input.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

PACKED = "dim int, block int, ids binary, data binary, extra binary"


def usable(vectors: DataFrame, ident: str, vector: str, zero: bool) -> DataFrame:
    """`_id, _v` (doubles) of rows that can take part: id and vector not null, not empty, all
    components finite; zero vectors only where `zero` is set."""
    v = F.col("_v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    rows = vectors.select(F.col(ident).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    rows = rows.where(F.col("_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad)
    return rows if zero else rows.where(F.exists(v, lambda x: x != 0))


def asked(rows: DataFrame, is_query: Column) -> DataFrame:
    """The query rows, one for each id."""
    return rows.where(is_query).groupBy("_id").agg(F.min("_v").alias("_v"))


def packed(
    rows: DataFrame, per_block: int, build: Callable[[np.ndarray, np.ndarray], tuple] | None = None, count: int | None = None
) -> tuple[DataFrame, int]:
    """Blocks of about `per_block` rows of `_id, _v` (and `_bound`, kept as extra), and the number of
    blocks of each dimension. `build(ids, matrix)` may reorder a block and add bytes."""
    total = rows.count() if count is None else count
    blocks = max(1, math.ceil(total / per_block))
    has_bound = "_bound" in rows.columns

    def pack(key: tuple[Any, ...], frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_id", kind="stable")
        ids = frame["_id"].to_numpy(np.int64)
        matrix = np.stack(frame["_v"].to_numpy()).astype(np.float64)
        extra = frame["_bound"].to_numpy(np.float64).tobytes() if has_bound else b""
        if build:
            ids, matrix, extra = build(ids, matrix)
        return pd.DataFrame(
            {"dim": [key[0]], "block": [key[1]], "ids": [ids.tobytes()], "data": [matrix.tobytes()], "extra": [extra]}
        )

    dealt = rows.withColumns(
        {"dim": F.size("_v"), "block": F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int")}
    )
    return dealt.groupBy("dim", "block").applyInPandas(pack, PACKED), blocks


def tiles(
    queries: DataFrame, query_blocks: int, data: DataFrame, data_blocks: int, search: Callable, schema: str
) -> DataFrame:
    """`search(query row, data row)` for every pair of a query block and a data block of one dimension;
    each pair is a task's group of two rows. A block travels once for each block of the other side."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    kinds = (
        queries.select(F.lit(0).alias("kind"), "dim", F.col("block").alias("q"), every(data_blocks).alias("d"), "ids", "data", "extra"),
        data.select(F.lit(1).alias("kind"), "dim", every(query_blocks).alias("q"), F.col("block").alias("d"), "ids", "data", "extra"),
    )

    def pair(frame: pd.DataFrame) -> pd.DataFrame:
        sides = {r.kind: r for r in frame.itertuples(index=False)}
        if len(sides) < 2:
            return pd.DataFrame({c.split()[0]: [] for c in schema.split(",")})
        return search(unpack(sides[0]), unpack(sides[1]))

    return kinds[0].union(kinds[1]).groupBy("dim", "q", "d").applyInPandas(pair, schema)


def unpack(row) -> tuple[np.ndarray, np.ndarray, bytes]:
    ids = np.frombuffer(row.ids, np.int64)
    return ids, np.frombuffer(row.data, np.float64).reshape(len(ids), row.dim), row.extra


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows, added up component by component in double precision."""
    total = np.zeros(len(left))
    for i in range(left.shape[1]):
        total += left[:, i] * right[:, i]
    return total


def best(rows: DataFrame, k: int, score: str) -> DataFrame:
    """The k best of each query, ranked from 1. Spark cuts each task's rows to k a query before the
    shuffle, so a query is never gathered whole."""
    order: list[Column] = [F.col("score").desc(), F.col("vec_id")]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast(score).alias("score")
    )

"""Running numbers and running totals over long ordered groups, in bounded pieces.

A window over a whole group would put it into one task. Here the rows are cut into
ordered blocks of limited size; what a block needs to know of the blocks before it is
summed up from one row per block.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import written

BLOCK = "_block"
ROWS_PER_BLOCK = 100_000


def ordered_blocks(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    rows_per_block: int = ROWS_PER_BLOCK,
    rows: int | None = None,
) -> DataFrame:
    """Rows with a `_block` number that rises with (group, order).

    `order` is unique within a group, so blocks are even. They are written once: range
    bounds come from a sample, and every use has to see the same ones. `rows` is their
    number, if known.
    """
    blocks = max(1, math.ceil((df.count() if rows is None else rows) / rows_per_block))
    ranged = df.repartitionByRange(blocks, *group, *order) if blocks > 1 else df.coalesce(1)
    return written(ranged.withColumn(BLOCK, F.spark_partition_id()), "blocks")


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "row_no",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Row numbers from 0 within each group, in order."""
    blocks = ordered_blocks(df, group, order, rows_per_block)
    sizes = blocks.groupBy(BLOCK, *group).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(BLOCK).alias("_b"),
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
    )
    inside = Window.partitionBy(BLOCK, *group).orderBy(*order)
    numbered = blocks.withColumn("_place", F.row_number().over(inside) - 1)
    same = F.col(BLOCK) == F.col("_b")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return numbered.join(offsets, same).select(*df.columns, (F.col("_offset") + F.col("_place")).alias(name))

"""Which small files are merged together: by size, by age, and in limited numbers.

A file is a row with its directory, modification time, path and length.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.keys import run_of
from .sequences import BLOCK, ROWS_PER_BLOCK, number_rows, ordered_blocks


MOST_ROWS_PER_BLOCK = 2_000_000

# The helpers below travel to the workers with the functions that use them, so that
# these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def sort_files(files: DataFrame, directory: str = "dir", mtime: str = "mtime", path: str = "path") -> DataFrame:
    """Oldest first within each directory."""
    return files.orderBy(directory, mtime, path)


def closings(lengths: np.ndarray, limit: int, carried: int) -> list[int]:
    """Places where the running total, starting from `carried`, reaches the limit and
    starts again from nothing."""
    totals = np.cumsum(lengths)
    found, base = [], -carried
    while True:
        at = int(np.searchsorted(totals, base + limit))
        if at >= len(totals):
            return found
        found.append(at)
        base = int(totals[at])


def block_summary(lengths: np.ndarray, limit: int) -> tuple[list[int], list[int], list[int], int]:
    """What a block does to any total carried into it.

    The carried total only decides where the first group closes. For each such place
    the result holds the least carried total that leads to it, the total carried out
    and the number of groups closed; places with the same outcome are joined. A carried
    total below all of them closes nothing and grows by the block's sum, given last.
    """
    totals = np.cumsum(lengths)
    size, whole = len(totals), int(totals[-1])
    # Where the next group closes if one starts right after each place.
    following = np.searchsorted(totals, totals + limit)
    carried_out = np.empty(size, dtype=np.int64)
    closed = np.empty(size, dtype=np.int64)
    for at in range(size - 1, -1, -1):
        after = following[at]
        if after >= size:
            carried_out[at], closed[at] = whole - totals[at], 1
        else:
            carried_out[at], closed[at] = carried_out[after], closed[after] + 1
    least, outs, counts = [], [], []
    reachable = int(np.searchsorted(totals, limit)) + 1
    for at in range(min(reachable, size)):
        if at and totals[at] == totals[at - 1]:
            continue
        bound = max(0, limit - int(totals[at]))
        if outs and outs[-1] == carried_out[at] and counts[-1] == closed[at]:
            least[-1] = bound
        else:
            least.append(bound)
            outs.append(int(carried_out[at]))
            counts.append(int(closed[at]))
    return least, outs, counts, whole


def plan_by_size(
    files: DataFrame,
    max_bytes: int,
    directory: Sequence[str] = ("dir",),
    order: Sequence[str] = ("mtime", "path"),
    length: str = "length",
    rows_per_block: int = ROWS_PER_BLOCK,
    groups_per_block: int = 10,
) -> DataFrame:
    """Adds `group_no`: files in order are added until their total reaches `max_bytes`,
    then the next group starts. The files of a last, unfilled group get null, as do all
    files when `max_bytes` is 0.

    The groups of a directory follow from one another, yet no directory is gone through
    by one task: blocks of files say what they make of any total carried in, those
    small answers are chained, and each block is then grouped by itself. An answer has
    as many entries as there are files in a block's first group, so blocks of very small
    files are made large enough for `groups_per_block` groups.
    """
    if max_bytes <= 0:
        return files.withColumn("group_no", F.lit(None).cast("bigint"))
    directory, order = list(directory), list(order)
    count, total = files.agg(F.count(F.lit(1)), F.sum(length)).first()
    files_per_group = max_bytes * count / (total or 1)
    rows_per_block = max(rows_per_block, min(int(groups_per_block * files_per_group), MOST_ROWS_PER_BLOCK))
    blocks = ordered_blocks(files, directory, order, rows_per_block, rows=count)
    key_fields = [T.StructField(BLOCK, T.IntegerType())] + [blocks.schema[d] for d in directory]
    keys = [BLOCK, *directory]
    columns = [*files.columns, "group_no"]

    def summarise(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        least, outs, counts, whole = block_summary(rows[length].to_numpy(np.int64), max_bytes)
        head = {k: rows[k].iloc[0] for k in keys}
        return pd.DataFrame([{**head, "least": least, "outs": outs, "counts": counts, "whole": whole}])

    longs = T.ArrayType(T.LongType())
    summaries = (
        blocks.select(*keys, *order, length)
        .groupBy(*keys)
        .applyInPandas(
            summarise,
            T.StructType(
                key_fields
                + [T.StructField(n, longs) for n in ("least", "outs", "counts")]
                + [T.StructField("whole", T.LongType())]
            ),
        )
    )

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(BLOCK)
        carried, closed, starts = 0, 0, []
        for least, outs, counts, whole in zip(rows["least"], rows["outs"], rows["counts"], rows["whole"]):
            starts.append((carried, closed))
            # The bounds fall, so the first that fits is found by halving.
            first = len(least) - int(np.searchsorted(np.asarray(least)[::-1], carried, side="right"))
            if first < len(least):
                carried, closed = int(outs[first]), closed + int(counts[first])
            else:
                carried += int(whole)
        found = rows[keys].copy()
        found["carried"], found["closed"] = [s[0] for s in starts], [s[1] for s in starts]
        found["all_closed"] = closed
        return found

    numbers = [T.StructField(n, T.LongType()) for n in ("carried", "closed", "all_closed")]
    starts = summaries.groupBy(*directory).applyInPandas(chain, T.StructType(key_fields + numbers))

    def number(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        places = closings(rows[length].to_numpy(np.int64), max_bytes, int(rows["carried"].iloc[0]))
        before = np.searchsorted(np.asarray(places, dtype=np.int64), np.arange(len(rows)))
        group = pd.Series(before + rows["closed"].to_numpy(), index=rows.index, dtype="Int64")
        rows["group_no"] = group.where(group < rows["all_closed"])
        return rows[columns]

    schema = T.StructType([*files.schema.fields, T.StructField("group_no", T.LongType())])
    same = None
    for at, key in enumerate(keys):
        starts = starts.withColumnRenamed(key, f"_key{at}")
        equal = blocks[key].eqNullSafe(F.col(f"_key{at}"))
        same = equal if same is None else same & equal
    return blocks.join(starts, same).groupBy(*keys).applyInPandas(number, schema)


def plan_by_age(
    files: DataFrame,
    now: Column,
    rollover_seconds: int,
    idle_seconds: int,
    mtime: str = "mtime",
    atime: str | None = None,
) -> DataFrame:
    """Files old enough to be merged although they fill no group. Where the file system
    tells no access time, the modification time stands for it. With a rollover of 0 the
    rule is off."""
    if rollover_seconds <= 0:
        return files.where(F.lit(False))

    def age(name: str) -> Column:
        return F.timestamp_diff("SECOND", F.col(name), now)

    return files.where((age(mtime) >= rollover_seconds) | (age(atime or mtime) >= idle_seconds))


def chunk_files(
    files: DataFrame,
    n: int = 1024,
    directory: Sequence[str] = ("dir",),
    order: Sequence[str] = ("mtime", "path"),
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Adds `chunk_no`: at most `n` files of a directory share one."""
    numbered = number_rows(files, directory, order, "_file_no", rows_per_block)
    return numbered.withColumn("chunk_no", run_of(F.col("_file_no"), n)).drop("_file_no")

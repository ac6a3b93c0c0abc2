"""Fixed time windows over rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.keys import run_of


def tumbling_window(
    df: DataFrame,
    ts: str,
    length: str,
    value: str,
    seq: str,
    keys: Sequence[str] = (),
    rows_per_list: int | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Values per window and key as a list in sequence order, a window's all in one. A stream needs a
    watermark for its windows to close.

    With `rows_per_list`, a window with more rows gives several lists, numbered by `part`: rows are
    numbered inside their window, so repeated `seq` do no harm. That needs a table, not a stream.
    """
    if watermark:
        df = df.withWatermark(ts, watermark)
    window = F.window(ts, length)
    if rows_per_list is None:
        grouped = df.groupBy(window, *keys)
    else:
        timed = df.withColumn("window", window)
        place = F.row_number().over(Window.partitionBy("window", *keys).orderBy(seq, value))
        grouped = timed.withColumn("part", run_of((place - 1).cast("bigint"), rows_per_list)).groupBy("window", *keys, "part")
    pairs = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col(value).alias("v"))))
    lists = grouped.agg(F.transform(pairs, lambda p: p.getField("v")).alias("rows"))
    part = F.lit(0).cast("bigint").alias("part") if rows_per_list is None else F.col("part")
    return lists.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, part, "rows"
    )


def apply_to_windows(
    df: DataFrame, ts: str, length: str, function: Callable, schema: str, keys: Sequence[str] = ()
) -> DataFrame:
    """`function(frame)` for each whole window and key of a table: it gets the rows as pandas, with
    `window_start` and `window_end`, and returns rows of `schema`. A window has to fit into a task."""
    window = F.window(ts, length)
    timed = df.withColumns({"window_start": window.getField("start"), "window_end": window.getField("end")})
    return timed.groupBy("window_start", "window_end", *keys).applyInPandas(lambda rows: function(rows), schema)

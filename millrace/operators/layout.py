"""Where rows go: regions, salts, day and partition directories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import LOGIC_PARTITIONS, region_of
from .shape import ROW_KEY


def assign_region(df: DataFrame, n_logic: int = LOGIC_PARTITIONS, n_physical: int = 16, key: str = ROW_KEY) -> DataFrame:
    return df.withColumn("region", region_of(F.col(key), n_logic, n_physical))


def spread_by_region(df: DataFrame, n_physical: int = 16, key: str = ROW_KEY) -> DataFrame:
    """Sorted runs of row keys, one range of keys per task, for loading in key order."""
    return df.repartitionByRange(n_physical, key).sortWithinPartitions(key)


def salt(df: DataFrame, n: int) -> DataFrame:
    """Rows spread evenly over `n` tasks, whatever their keys."""
    return df.repartition(n)


def day_bucket(df: DataFrame, ts: str, name: str = "dt") -> DataFrame:
    return df.withColumn(name, F.date_format(ts, "yyyy-MM-dd"))


def spread_for_write(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a partition brought together before a partitioned write. The split is
    made at run time by size, so a very large partition is written by many tasks and
    a small one makes one file."""
    return df.hint("rebalance", *columns) if columns else df


def write_partitioned(
    df: DataFrame,
    path: str,
    columns: Sequence[str | tuple[str, Column]],
    fmt: str = "parquet",
    mode: str = "append",
    **options: str,
) -> None:
    """Files in `k=v` directories. A column is a name, or a name and the expression that
    gives its value."""
    names = []
    for item in columns:
        name, expression = item if isinstance(item, tuple) else (item, None)
        names.append(name)
        if expression is not None:
            df = df.withColumn(name, expression)
    writer = spread_for_write(df, names).write.format(fmt).mode(mode).options(**options)
    (writer.partitionBy(*names) if names else writer).save(path)


def single_writer(df: DataFrame) -> DataFrame:
    """One output file; only for small, bounded frames."""
    return df.coalesce(1)

"""Reads from stored tables: by partition, by key, by version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F


def partitions_where(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows whose partition columns have the given values, compared in the column's own
    type so that whole partitions are skipped; None stands for the null partition."""
    for name, value in values.items():
        c = F.col(name)
        df = df.where(c.isNull() if value is None else c == F.lit(value).cast(df.schema[name].dataType))
    return df


def scan(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*columns) if columns else df


def scan_limit(df: DataFrame, columns: Sequence[str] | None, n: int, key: str) -> DataFrame:
    """The first `n` rows by key."""
    return scan(df.orderBy(key).limit(n), columns)


def get_rows(df: DataFrame, key: str, keys: DataFrame | object) -> DataFrame:
    """The row of one key, or the rows of a frame of keys."""
    if isinstance(keys, DataFrame):
        return df.join(keys.select(key).distinct(), key, "left_semi")
    return df.where(F.col(key) == F.lit(keys))


def get_versions(log: DataFrame, key: str, seq: str, value: object = None, keep: int | None = None) -> DataFrame:
    """Kept versions, newest first: of one key, or of every key if none is named.

    With `keep`, only so many of the newest per key remain; each input partition drops
    the others before the shuffle.
    """
    if value is not None:
        log = log.where(F.col(key) == F.lit(value)).orderBy(F.desc(seq))
        return log.limit(keep) if keep else log
    if keep is None:
        return log.orderBy(key, F.desc(seq))
    newest = Window.partitionBy(key).orderBy(F.desc(seq))
    return log.withColumn("version", F.row_number().over(newest)).where(F.col("version") <= keep)


def missing_partitions(found: DataFrame, registered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partitions that exist but are not registered; null values match each other."""
    found = found.select(*keys).distinct()
    same = None
    for name in keys:
        equal = found[name].eqNullSafe(registered[name])
        same = equal if same is None else same & equal
    return found.join(registered, same, "left_anti")


def rows_of_partitions(df: DataFrame, wanted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose partition columns take one of the value sets that a frame holds. The frame's values
    prune the partitions that are read, at run time; a partition asked for twice comes once. Nulls in the
    frame stand for the null partition where all columns are null there."""
    values = wanted.select(*columns).distinct()
    return df.join(values, list(columns), "left_semi")

"""What files a table has, as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def plain_path(uri: Column) -> Column:
    """A file's URI, as `_metadata` gives it, in the form the file system takes."""
    return F.regexp_replace(unescape(uri), "^file:/+", "file:/")


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """`dir, path, mtime, length` of the files below a path; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    meta = F.col("_metadata")
    full = plain_path(meta.getField("file_path"))
    return reader.load(path).select(
        F.regexp_replace(full, "/[^/]*$", "").alias("dir"),
        full.alias("path"),
        meta.getField("file_modification_time").alias("mtime"),
        meta.getField("file_size").alias("length"),
    )


def unescape(c: Column) -> Column:
    """The value in a `k=v` directory name."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def partition_value(directory: Column, key: str) -> Column:
    text = F.regexp_extract(directory, rf"/{key}=([^/]*)", 1)
    return F.when(text != "__HIVE_DEFAULT_PARTITION__", unescape(text))


def leaf_partitions(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Partition directories that hold files, with the value of every key as text."""
    directories = list_files(spark, path).select("dir").distinct()
    for key in keys:
        directories = directories.where(F.col("dir").contains(f"/{key}="))
    return directories.select("dir", *[partition_value(F.col("dir"), k).alias(k) for k in keys])


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows in each file that a file-based frame reads."""
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))

"""Publishing staged files: a manifest first, then the moves it lists.

A unit of work has a directory with `data/` (staged files) and `manifest/` (what moves
where, and which files go). A manifest counts once Spark has marked it complete. From
then on the work is only ever finished; before, it is only ever dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.fs import Files

MANIFEST_SCHEMA = "action string, source string, target string"


def is_published(files: Files, unit: str) -> bool:
    return files.exists(f"{unit}/manifest/_SUCCESS")


def publish(unit: str, moves: DataFrame, removals: DataFrame | None = None) -> None:
    """Write the manifest: `moves` has source and target, `removals` has path."""
    rows = moves.select(F.lit("move").alias("action"), "source", "target")
    if removals is not None:
        gone = removals.select(F.lit("remove").alias("action"), F.col("path").alias("source"), F.lit(None).cast("string").alias("target"))
        rows = rows.unionByName(gone)
    rows.write.mode("overwrite").parquet(f"{unit}/manifest")


def manifest(spark: SparkSession, unit: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{unit}/manifest")


def finish(spark: SparkSession, files: Files, unit: str, keep: bool = False) -> None:
    """Do what a published manifest says; may be repeated. Moves come before removals, so
    rows are never missing. With `keep` the manifest stays as proof of the work."""
    listed = manifest(spark, unit)
    moves = listed.where("action = 'move'")
    Files.each(lambda row: files.move(row["source"], row["target"]), moves.toLocalIterator())
    removals = listed.where("action = 'remove'")
    Files.each(lambda row: files.delete(row["source"]), removals.toLocalIterator())
    files.delete(f"{unit}/data" if keep else unit)


def recover(spark: SparkSession, files: Files, work: str, keep: bool = False) -> None:
    """Finish published units of work and drop the others."""
    for name in files.names(work):
        unit = f"{work}/{name}"
        if is_published(files, unit):
            finish(spark, files, unit, keep)
        else:
            files.delete(unit)

"""Merging the small files of a table.

One job reads the chosen files, shuffles each group's rows to a task and writes one
file per group. The result is staged and published, see `commit`.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.keys import run_of
from ..session import scratch_scope, written
from ..sources.files import list_files, plain_path
from ..sources.fs import Files
from ..spec import RollingPolicy
from . import commit
from .grouping import chunk_files, plan_by_age, plan_by_size

WORK = "_compaction"
NEW_FILES, MERGED_FILES = "part-*", "merged-*"
FILES_PER_UNIT = 10_000
# Working columns beside a table's own.
GROUP, FILE, PIECE = "merge_group", "_merge_file", "_merge_piece"
EXTENSIONS = {"parquet": "parquet", "orc": "orc", "text": "txt"}


def _file_number(path: Column) -> Column:
    """What tells the files of one job apart: the task and its file counter."""
    task = F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1)
    counter = F.regexp_extract(path, r"[.-]c(\d+)(?:\.(?!c\d)[a-z0-9]+)+$", 1)
    return F.concat_ws("-", task, counter)


def plan_groups(files: DataFrame, policy: RollingPolicy, now: datetime) -> DataFrame:
    """`dir, path, length, grp`: files to be merged, by the size rule and then, for what
    that leaves over, by the age rule."""
    sized = plan_by_size(files, policy.max_part_bytes)
    full = sized.where(F.col("group_no").isNotNull())
    rest = sized.where(F.col("group_no").isNull() & F.col("path").rlike("/part-[^/]*$")).drop("group_no")
    old = plan_by_age(rest, F.lit(now), policy.rollover_seconds, policy.idle_seconds)
    aged = chunk_files(old, policy.files_per_group)
    by_size = full.select("dir", "path", "length", F.concat(F.lit("s"), F.col("group_no")).alias("grp"))
    by_age = aged.select("dir", "path", "length", F.concat(F.lit("a"), F.col("chunk_no")).alias("grp"))
    return by_size.unionByName(by_age)


def compact(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    policy: RollingPolicy = RollingPolicy(enabled=True),
    now: datetime | None = None,
    schema: T.StructType | None = None,
) -> int:
    """Merge small files below `path`; the number of groups merged.

    `schema` is the table's, if a catalog has it. Otherwise it is put together from all files, so that
    no column of any file is lost; files that disagree on a column's type are an error, and nothing is
    changed. Groups of one file are left alone. A group with more bytes than the policy's size,
    because its last file is large, is written as several files. Files of an earlier merge take part
    in the size rule while they are below half its size.
    """
    fs = Files(spark, path)
    root = fs.qualified(path)
    commit.recover(spark, fs, f"{root}/{WORK}")
    with scratch_scope(spark):
        return _merge_files(spark, fs, root, fmt, policy, now or datetime.now(timezone.utc), schema)


def candidates(spark: SparkSession, root: str, policy: RollingPolicy) -> DataFrame:
    """New files, and merged ones of less than half the size."""
    merged = list_files(spark, root, MERGED_FILES).where(F.col("length") * 2 < policy.max_part_bytes)
    return list_files(spark, root, NEW_FILES).union(merged)


def merged_schema(spark: SparkSession, root: str, fmt: str) -> T.StructType:
    """All columns of all files."""
    reader = spark.read.format(fmt)
    return (reader if fmt == "text" else reader.option("mergeSchema", "true")).load(root).schema


def _merge_files(
    spark: SparkSession, fs: Files, root: str, fmt: str, policy: RollingPolicy, now: datetime, schema: T.StructType | None
) -> int:
    planned = written(plan_groups(candidates(spark, root, policy), policy, now), "compaction-plan")
    piece_bytes = max(1, policy.max_part_bytes) if policy.max_part_bytes > 0 else 1 << 40
    groups = planned.groupBy("dir", "grp").agg(
        F.count(F.lit(1)).alias("files"), F.ceil(F.sum("length") / piece_bytes).alias("pieces")
    )
    groups = groups.where("files > 1").withColumn(GROUP, F.monotonically_increasing_id())
    groups = written(groups, "compaction-groups")
    if groups.isEmpty():
        return 0
    inputs = written(planned.join(groups, ["dir", "grp"]).select(F.col("path").alias(FILE), GROUP, "dir", "pieces"), "compaction-inputs")
    schema = schema or merged_schema(spark, root, fmt)
    merged = 0
    # A unit of work reads the files of some groups and no others, and is published by itself.
    for part in _units(inputs):
        merged += _merge_unit(spark, fs, root, fmt, schema, inputs, part, piece_bytes, now)
    return merged


def _units(inputs: DataFrame) -> Iterator[list]:
    """Planned files in lists of whole groups, a list of about `FILES_PER_UNIT` at a time."""
    unit: list = []
    for row in inputs.orderBy(GROUP).toLocalIterator():
        if len(unit) >= FILES_PER_UNIT and row[GROUP] != unit[-1][GROUP]:
            yield unit
            unit = []
        unit.append(row)
    yield unit


def planned_rows(spark: SparkSession, root: str, fmt: str, schema: T.StructType, paths: list[str]) -> DataFrame:
    """The rows of planned files; only they are read."""
    reader = spark.read.format(fmt).option("basePath", root)
    # Lines are moved as they are, whatever columns they hold.
    return (reader if fmt == "text" else reader.schema(schema)).load(paths)


def _merge_unit(
    spark: SparkSession, fs: Files, root: str, fmt: str, schema: T.StructType, inputs: DataFrame, files: list,
    piece_bytes: int, now: datetime,
) -> int:
    name = uuid.uuid4().hex
    unit = f"{root}/{WORK}/{name}"
    numbers = [r[GROUP] for r in files]
    mine = inputs.where(F.col(GROUP).between(min(numbers), max(numbers)))
    partition_columns = re.findall(r"/([^/=]+)=", files[0]["dir"].removeprefix(root))
    rows = planned_rows(spark, root, fmt, schema, [r[FILE] for r in files])
    meta = F.col("_metadata")
    chosen = rows.select(
        *[F.col(f"`{c}`") for c in rows.columns if c not in partition_columns],
        plain_path(meta.getField("file_path")).alias(FILE),
        run_of(meta.getField("file_block_start"), piece_bytes).alias(PIECE),
    )
    pieces = sum({r[GROUP]: r["pieces"] for r in files}.values())
    count = len(set(numbers))
    staged = chosen.join(mine.select(FILE, GROUP), FILE).drop(FILE)
    staged = staged.repartition(max(count, pieces), GROUP, PIECE).drop(PIECE)
    staged.write.format(fmt).partitionBy(GROUP).save(f"{unit}/data")

    outputs = list_files(spark, f"{unit}/data", NEW_FILES).select(
        F.col("path").alias("source"), F.regexp_extract("dir", rf"/{GROUP}=(\d+)$", 1).cast("bigint").alias(GROUP)
    )
    stamp = now.strftime("%Y%m%d%H%M%S")
    target = F.concat(
        "dir", F.lit(f"/merged-{stamp}-{name[:12]}-"), GROUP, F.lit("-"), _file_number(F.col("source")),
        F.lit(f".{EXTENSIONS[fmt]}"),
    )
    moves = outputs.join(mine.select(GROUP, "dir").distinct(), GROUP).select("source", target.alias("target"))
    commit.publish(unit, moves, mine.select(F.col(FILE).alias("path")))
    commit.finish(spark, fs, unit)
    return count


def recover_compaction(spark: SparkSession, path: str) -> None:
    """Finish or undo a merge that was broken off."""
    fs = Files(spark, path)
    commit.recover(spark, fs, f"{fs.qualified(path)}/{WORK}")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """The rows of a table with the columns of all its files, or those of `schema`, each row once, also while a published merge is being finished:
    of the merged files and those they came from, only one side is read."""
    fs = Files(spark, path)
    root = fs.qualified(path)
    loaded = spark.read.format(fmt).schema(schema or merged_schema(spark, root, fmt)).load(root)
    rows = loaded.select("*", plain_path(F.col("_metadata.file_path")).alias(FILE))
    for name in fs.names(f"{root}/{WORK}"):
        unit = f"{root}/{WORK}/{name}"
        if not commit.is_published(fs, unit):
            continue
        listed = commit.manifest(spark, unit)
        moved = listed.where("action = 'move'").select(F.col("target").alias(FILE))
        gone = listed.where("action = 'remove'").select(F.col("source").alias(FILE))
        # Removals start when all moves are done: until then the inputs are the table.
        arrived = list_files(spark, root, "merged-*").select(F.col("path").alias(FILE))
        pending = not moved.join(arrived, FILE, "left_anti").isEmpty()
        rows = rows.join(moved if pending else gone, FILE, "left_anti")
    return rows.select(*loaded.columns)


def is_committed(spark: SparkSession, table_path: str, tag: str) -> bool:
    """Whether a tag's manifest is published; its files may still have to be moved, so
    nothing may be staged for it again."""
    fs = Files(spark, table_path)
    return commit.is_published(fs, f"{fs.qualified(table_path)}/_commits/{tag}")


def commit_staged(
    spark: SparkSession, stage: str, table_path: str, tag: str, fmt: str = "parquet"
) -> None:
    """Move finished files from a stage directory into the table's partitions, with the
    tag in their names. A tag that is committed already is only finished, not repeated."""
    fs = Files(spark, table_path)
    root = fs.qualified(table_path)
    unit = f"{root}/_commits/{tag}"
    if not commit.is_published(fs, unit):
        source = fs.qualified(stage)
        staged = list_files(spark, source, NEW_FILES)
        below = F.expr(f"substring(dir, {len(source) + 1})")
        target = F.concat(
            F.lit(root), below, F.lit(f"/part-{tag}-"), _file_number(F.col("path")), F.lit(f".{EXTENSIONS[fmt]}")
        )
        commit.publish(unit, staged.select(F.col("path").alias("source"), target.alias("target")))
    commit.finish(spark, fs, unit, keep=True)
    fs.delete(stage)


def forget_commits(spark: SparkSession, table_path: str, keep_seconds: float = 7 * 86400, now: float | None = None) -> None:
    """Drop the marks of tags that were committed longer ago, whatever their job and number; a
    stream repeats its last batch at most."""
    fs = Files(spark, table_path)
    root = f"{fs.qualified(table_path)}/_commits"
    before = (time.time() if now is None else now) - keep_seconds
    for name in fs.names(root):
        if fs.modified(f"{root}/{name}") < before:
            fs.delete(f"{root}/{name}")

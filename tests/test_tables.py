"""Files, partitions, catalog tables and compaction."""

from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import layout, lookup
from millrace.plans import commit, compaction, grouping, sequences
from millrace.session import scratch_path
from millrace.sources import files, tables
from millrace.sources.fs import Files
from millrace.spec import RollingPolicy

LATER = datetime.now(timezone.utc) + timedelta(hours=1)
BY_SIZE = RollingPolicy(enabled=True, max_part_bytes=4000, rollover_seconds=0)
BY_AGE = RollingPolicy(enabled=True, max_part_bytes=0, files_per_group=3)


def greedy(lengths, limit):
    """Group numbers one file at a time; None where the group stays open."""
    groups, total, number = [], 0, 0
    for length in lengths:
        groups.append(number)
        total += length
        if total >= limit:
            total, number = 0, number + 1
    return [g if g < number else None for g in groups]


@pytest.mark.parametrize("seed,limit,block", [(1, 100, 7), (2, 1000, 5), (3, 5, 10), (4, 300, 1000), (5, 50, 3)])
def test_size_groups_match_one_by_one(spark, seed, limit, block):
    draw = np.random.default_rng(seed)
    data, want = [], {}
    for directory, n in (("hot", 150), ("b", 20), ("c", 1), (None, 30)):
        lengths = [int(v) for v in draw.integers(0, 60, n)]
        paths = [f"{directory}{i:04d}" for i in range(n)]
        data += [(directory, p, i // 4, v) for i, (p, v) in enumerate(zip(paths, lengths))]
        want.update(zip(paths, greedy(lengths, limit)))
    frame = spark.createDataFrame(data, "dir string, path string, mtime int, length bigint").repartition(5)
    for groups in (0, 2):
        planned = grouping.plan_by_size(frame, limit, rows_per_block=block, groups_per_block=groups)
        assert {r["path"]: r["group_no"] for r in planned.collect()} == want


def test_block_summary_agrees_with_every_carried_total():
    draw = np.random.default_rng(9)
    for _ in range(40):
        lengths, limit = draw.integers(0, 9, draw.integers(1, 25)), int(draw.integers(1, 30))
        least, outs, counts, whole = grouping.block_summary(lengths, limit)
        for carried in range(limit):
            places = grouping.closings(lengths, limit, carried)
            out = int(lengths[places[-1] + 1 :].sum()) if places else carried + whole
            fits = [i for i, b in enumerate(least) if b <= carried]
            got = (outs[fits[0]], counts[fits[0]]) if fits else (carried + whole, 0)
            assert got == (out, len(places))


def test_row_numbers_and_chunks(spark):
    data = [("hot", i, i % 5) for i in range(100)] + [(None, i, 0) for i in range(7)]
    frame = spark.createDataFrame(data, "dir string, path int, mtime int").repartition(4)
    numbered = sequences.number_rows(frame, ["dir"], ["mtime", "path"], rows_per_block=9)
    for directory in ("hot", None):
        mine = sorted((m, p) for d, p, m in data if d == directory)
        got = {(r["mtime"], r["path"]): r["row_no"] for r in numbered.collect() if r["dir"] == directory}
        assert got == {pair: i for i, pair in enumerate(mine)}
    sizes = grouping.chunk_files(frame, 16, rows_per_block=9).groupBy("dir", "chunk_no").count().collect()
    assert sorted(r["count"] for r in sizes if r["dir"] == "hot") == [4] + [16] * 6


def test_files_sorted_by_age(rows):
    frame = rows("dir string, path string, mtime int", ("b", "x", 2), ("a", "y", 5), ("a", "z", 1))
    assert [r["path"] for r in grouping.sort_files(frame).collect()] == ["z", "y", "x"]


def test_age_rule(rows):
    frame = rows("path string, age int", ("a", 10), ("b", 59), ("c", 60)).select(
        "path", (F.lit(LATER) - F.make_dt_interval(secs=F.col("age").cast("decimal(18,6)"))).alias("mtime")
    )
    old = grouping.plan_by_age(frame, F.lit(LATER), 60, 3600)
    assert [r["path"] for r in old.collect()] == ["c"]
    assert grouping.plan_by_age(frame, F.lit(LATER), 60, 59).count() == 2
    assert grouping.plan_by_age(frame, F.lit(LATER), 0, 1).count() == 0


def small_files(spark, fmt, n=12):
    path = scratch_path(spark, f"table-{fmt}")
    data = spark.range(600).select(
        F.concat(F.lit("v"), "id").alias("value"), F.when(F.col("id") % 3 == 0, "x/y").otherwise("b").alias("p")
    )
    data.repartition(n).write.format(fmt).partitionBy("p").save(path)
    return path


def snapshot(df):
    return sorted(tuple(r) for r in df.select("value", "p").collect())


@pytest.mark.parametrize("fmt", ["parquet", "orc", "text"])
def test_compaction_keeps_rows_and_lessens_files(spark, fmt):
    path = small_files(spark, fmt)
    before = snapshot(spark.read.format(fmt).load(path))
    count = files.list_files(spark, path).count()
    by_size = RollingPolicy(enabled=True, max_part_bytes=400 if fmt == "text" else 3000, rollover_seconds=0)
    assert compaction.compact(spark, path, fmt, by_size, now=LATER) > 0
    after = files.list_files(spark, path)
    assert after.count() < count
    assert snapshot(spark.read.format(fmt).load(path)) == before == snapshot(compaction.read_table(spark, path, fmt))
    assert compaction.compact(spark, path, fmt, BY_AGE, now=LATER) >= 0
    assert snapshot(spark.read.format(fmt).load(path)) == before
    assert Files(spark, path).names(f"{path}/_compaction") == []


def test_compaction_by_age_in_limited_groups(spark):
    path = small_files(spark, "parquet", n=8)
    assert compaction.compact(spark, path, policy=BY_AGE, now=datetime.now(timezone.utc) - timedelta(days=1)) == 0
    assert compaction.compact(spark, path, policy=BY_AGE, now=LATER) == 6
    assert files.list_files(spark, path, "merged-*").count() == 6
    # Merged files are not taken up again.
    assert compaction.compact(spark, path, policy=BY_AGE, now=LATER) == 0


def test_compaction_keeps_columns_that_only_some_files_have(spark):
    path = scratch_path(spark, "evolved")
    spark.range(10).selectExpr("id AS a", "id AS b").coalesce(1).write.parquet(path)
    spark.range(10).selectExpr("id AS a", "id AS b", "id AS c").coalesce(1).write.mode("append").parquet(path)
    assert compaction.compact(spark, path, now=LATER) == 1
    assert spark.read.parquet(path).agg(F.count("a"), F.count("c"), F.sum("c")).first()[:] == (20, 10, 45)
    odd = scratch_path(spark, "conflict")
    spark.range(9).selectExpr("id AS a").coalesce(1).write.parquet(odd)
    spark.range(9).selectExpr("cast(id AS string) AS a").coalesce(1).write.mode("append").parquet(odd)
    with pytest.raises(Exception, match="(?i)merg|type"):
        compaction.compact(spark, odd, now=LATER)
    assert files.list_files(spark, odd, "*.parquet").count() == 2


def test_compaction_reads_planned_files_only(spark, monkeypatch):
    path = scratch_path(spark, "planned")
    spark.range(500_000).selectExpr("id", "uuid() AS t").coalesce(1).write.parquet(path)
    for _ in range(3):
        spark.range(10).selectExpr("id", "'x' AS t").coalesce(1).write.mode("append").parquet(path)
    seen = []
    reads = compaction.planned_rows

    def watched(*args):
        found = reads(*args)
        seen.extend(found.inputFiles())
        return found

    monkeypatch.setattr(compaction, "planned_rows", watched)
    policy = RollingPolicy(enabled=True, max_part_bytes=1 << 20, rollover_seconds=1, idle_seconds=1)
    large = files.list_files(spark, path).where("length > 1000000").first()["path"].rsplit("/", 1)[1]
    compaction.compact(spark, path, policy=policy, now=LATER)
    first = [f for f in seen if large in f]
    seen.clear()
    spark.range(10).selectExpr("id", "'x' AS t").coalesce(2).write.mode("append").parquet(path)
    assert compaction.compact(spark, path, policy=policy, now=LATER) >= 1
    assert len(first) <= 1 and not [f for f in seen if large in f]
    assert spark.read.parquet(path).count() == 500_040


def test_small_merged_files_are_taken_up_by_size(spark):
    path = scratch_path(spark, "ticks")
    policy = RollingPolicy(enabled=True, max_part_bytes=4000, rollover_seconds=1, idle_seconds=1)
    for tick in range(6):
        spark.range(tick * 100, tick * 100 + 100).repartition(2).write.mode("append").parquet(path)
        compaction.compact(spark, path, policy=policy, now=LATER)
    assert spark.read.parquet(path).agg(F.count("id"), F.sum("id")).first()[:] == (600, 600 * 599 // 2)
    assert files.list_files(spark, path, "merged-*").count() < 6


def test_compaction_of_a_table_without_partitions(spark):
    path = scratch_path(spark, "flat")
    spark.range(100).repartition(6).write.parquet(path)
    assert compaction.compact(spark, path, policy=RollingPolicy(enabled=True), now=LATER) == 1
    assert spark.read.parquet(path).agg(F.sum("id"), F.count("id")).first()[:] == (4950, 100)
    assert files.list_files(spark, path, "*.parquet").count() == 1


class Broken(RuntimeError):
    pass


@pytest.mark.parametrize("stage", ["before publish", "before moves", "between moves", "between removals"])
def test_broken_compaction_is_finished_or_undone(spark, monkeypatch, stage):
    path = small_files(spark, "parquet")
    before = snapshot(spark.read.parquet(path))
    move, delete, calls = Files.move, Files.delete, []

    def fail(*_args, **_kw):
        raise Broken()

    def some_moves(self, source, target):
        calls.append(source)
        if len(calls) > 1:
            raise Broken()
        move(self, source, target)

    def some_removals(self, target):
        if "/part-" in target:
            calls.append(target)
            if len(calls) > 3:
                raise Broken()
        delete(self, target)

    with monkeypatch.context() as patch:
        if stage == "before publish":
            patch.setattr(commit, "publish", fail)
        elif stage == "before moves":
            patch.setattr(commit, "finish", fail)
        elif stage == "between moves":
            patch.setattr(Files, "move", some_moves)
        else:
            patch.setattr(Files, "delete", some_removals)
        with pytest.raises(Broken):
            compaction.compact(spark, path, policy=BY_SIZE, now=LATER)
    assert snapshot(compaction.read_table(spark, path)) == before
    compaction.recover_compaction(spark, path)
    assert snapshot(spark.read.parquet(path)) == before
    assert Files(spark, path).names(f"{path}/_compaction") == []
    merged = files.list_files(spark, path, "merged-*").count()
    assert (merged == 0) == (stage == "before publish")


def test_large_last_file_is_split_over_tasks(spark):
    path = scratch_path(spark, "large")
    spark.range(10).write.parquet(path)
    spark.range(10, 1_600_000).repartition(1).write.mode("append").option("parquet.block.size", 1 << 18).parquet(path)
    policy = RollingPolicy(enabled=True, max_part_bytes=1 << 20, rollover_seconds=1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 19))
    try:
        compaction.compact(spark, path, policy=policy, now=LATER)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert spark.read.parquet(path).agg(F.count("id"), F.sum("id")).first()[:] == (1_600_000, 1_600_000 * 1_599_999 // 2)
    assert files.list_files(spark, path, "merged-*").count() > 1


def test_commit_staged_is_done_once(spark):
    target, stage = scratch_path(spark, "committed"), scratch_path(spark, "stage")
    data = spark.range(50).withColumn("p", F.col("id") % 2)
    for _ in range(2):
        data.write.mode("overwrite").partitionBy("p").parquet(stage)
        compaction.commit_staged(spark, stage, target, "batch000000000001")
    assert spark.read.parquet(target).count() == 50
    data.write.partitionBy("p").parquet(stage)
    compaction.commit_staged(spark, stage, target, "batch000000000002")
    assert spark.read.parquet(target).count() == 100
    compaction.forget_commits(spark, target)
    assert len(Files(spark, target).names(f"{target}/_commits")) == 2
    compaction.forget_commits(spark, target, keep_seconds=-5)
    assert Files(spark, target).names(f"{target}/_commits") == []


def test_partition_directories(spark):
    path = small_files(spark, "parquet", n=2)
    (spark.range(1).selectExpr("'n' AS value", "cast(null AS string) AS p")
     .write.mode("append").partitionBy("p").parquet(path))
    found = files.leaf_partitions(spark, path, ["p"])
    assert {r["p"] for r in found.collect()} == {"x/y", "b", None}
    listed = files.list_files(spark, path, "*.parquet").first()
    assert listed["length"] > 0 and listed["path"].startswith(listed["dir"])
    counts = files.rows_per_file(spark.read.parquet(path))
    assert counts.agg(F.sum("rows")).first()[0] == 601


def test_missing_partitions_match_nulls(rows):
    found = rows("a string, b string", ("1", None), ("1", None), ("1", "x"), ("2", "y"))
    known = rows("a string, b string", ("1", None), ("2", "y"))
    assert [tuple(r) for r in lookup.missing_partitions(found, known, ["a", "b"]).collect()] == [("1", "x")]


@pytest.fixture
def catalog_table(spark):
    name = "many_keys"
    tables.drop_table(spark, name)
    keys = [("k", "string"), ("a", "tinyint"), ("b", "smallint"), ("c", "int"), ("d", "bigint"), ("f", "double"),
            ("h", "boolean"), ("j", "string")]
    ddl = "id bigint, name string, " + ", ".join(f"{n} {t}" for n, t in keys)
    tables.ensure_table(spark, name, ddl, [n for n, _ in keys])
    yield name, keys
    tables.drop_table(spark, name)


def test_catalog_partitions(spark, catalog_table):
    name, keys = catalog_table
    info = tables.describe_table(spark, name)
    assert info.partition_columns == tuple(n for n, _ in keys) and info.format == "parquet"
    assert info.data_columns == (("id", "bigint"), ("name", "string"))
    row = ("it's", 1, 2, 3, 4, 1.5, True, "x/y")
    data = spark.createDataFrame([(1, "n", *row), (2, "m", "b", *row[1:])], "id bigint, name string, " + ", ".join(f"{n} {t}" for n, t in keys))
    layout.write_partitioned(data, info.location, [n for n, _ in keys])
    assert spark.table(name).count() == 0
    assert tables.add_partitions(spark, name, batch=1) == 2
    assert tables.add_partitions(spark, name) == 0
    found = lookup.partitions_where(spark.table(name), dict(zip([n for n, _ in keys], row)))
    assert [r["id"] for r in found.collect()] == [1]
    assert "PartitionFilters: [" in found._jdf.queryExecution().executedPlan().toString()
    data.withColumn("k", F.lit("new")).write.mode("append").partitionBy(*[n for n, _ in keys]).parquet(info.location)
    tables.refresh_partitions(spark, name)
    assert spark.table(name).count() == 4


def test_truncate_and_drop(spark):
    tables.ensure_table(spark, "short_lived", "id bigint")
    tables.ensure_table(spark, "short_lived", "id bigint")
    spark.range(3).write.insertInto("short_lived")
    tables.truncate_table(spark, "short_lived")
    assert spark.table("short_lived").count() == 0
    tables.drop_table(spark, "short_lived")
    tables.drop_table(spark, "short_lived")
    assert not spark.catalog.tableExists("short_lived")


def test_formats():
    assert tables.storage_format("PARQUET") == "parquet"
    assert tables.storage_format("hive", "org.apache.hadoop.hive.ql.io.orc.OrcSerde") == "orc"
    assert tables.storage_format("csv") == "text"
    with pytest.raises(ValueError):
        tables.storage_format("avro")


def test_conform(rows):
    data = rows("a string, b double, arr string, n array<int>", ("12", 3.9, '["x"]', [1, 2]), ("x", 1e12, "?", None))
    columns = [("a", "int"), ("b", "smallint"), ("arr", "array<string>"), ("n", "string"), ("none", "date")]
    got = [tuple(r) for r in tables.conform(data, columns).collect()]
    assert got == [(12, 3, ["x"], "[1,2]", None), (None, None, None, None, None)]


def test_versions_and_point_reads(spark, rows):
    log = rows("k int, s int, v string", *[(i % 3, i, f"v{i}") for i in range(12)])
    assert [r["v"] for r in lookup.get_versions(log, "k", "s", 1).collect()] == ["v10", "v7", "v4", "v1"]
    assert [r["v"] for r in lookup.get_versions(log, "k", "s", 1, keep=2).collect()] == ["v10", "v7"]
    kept = lookup.get_versions(log, "k", "s", keep=2)
    assert kept.count() == 6
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()
    assert lookup.get_rows(log, "k", 2).count() == 4
    assert lookup.scan_limit(log, ["v"], 2, "s").collect() == [("v0",), ("v1",)]

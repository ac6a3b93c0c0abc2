"""Queries whose operators write: files, catalog tables, sinks and streams. Each writes what it needs
from the given tables below the session's shared folder and returns what can be read back."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F

from millrace.functions import keys
from millrace.operators import layout, lookup, quality
from millrace.plans import compaction
from millrace.session import scratch_path, written
from millrace.sources import files, sinks, tables
from millrace.sources.keyed import KeyedTable
from millrace.spec import JobSpec, RollingPolicy, SinkSpec
from millrace.streaming.ingest import Ingest
from millrace.streaming.windows import tumbling_window

from .messages import EDGE_MIX, messages, table
from .queries import _is_delete, _log, _target, query

START = datetime(2024, 2, 1, tzinfo=timezone.utc)
FLAGS = ["l_returnflag", "l_linestatus"]


def _named(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex}"


def _day(name: str):
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def _items_by_flag(spark, sf):
    """lineitem below `flag=value` directories."""
    path = scratch_path(spark, "items")
    layout.write_partitioned(table(spark, sf, "lineitem"), path, FLAGS)
    return path


@query
def partition_lookup(spark, sf):
    rows = spark.read.parquet(_items_by_flag(spark, sf))
    found = lookup.partitions_where(rows, {"l_returnflag": "A", "l_linestatus": "F"})
    return found.select("l_orderkey", "l_linenumber", "l_partkey", *FLAGS)


@query
def list_files(spark, sf):
    """Directories of the written files, none of them empty."""
    found = files.list_files(spark, _items_by_flag(spark, sf), "*.parquet")
    return found.select(
        files.partition_value(F.col("dir"), "l_returnflag").alias("l_returnflag"), (F.col("length") > 0).alias("filled")
    ).distinct()


@query
def leaf_partitions(spark, sf):
    return files.leaf_partitions(spark, _items_by_flag(spark, sf), FLAGS).select(*FLAGS)


@query
def rows_per_file(spark, sf):
    """Rows of the files of each directory, from the numbers of rows in each file."""
    counts = files.rows_per_file(spark.read.parquet(_items_by_flag(spark, sf)))
    flag = files.partition_value(files.plain_path(F.col("path")), "l_returnflag").alias("l_returnflag")
    return counts.groupBy(flag).agg(F.sum("rows").alias("n"))


def _items_table(spark, location):
    name = _named("items")
    columns = "l_orderkey bigint, l_linenumber int, l_returnflag string, l_linestatus string"
    tables.ensure_table(spark, name, columns, FLAGS, location=location)
    return name


def _partitions_seen(spark, name):
    rows = written(spark.table(name).groupBy(*FLAGS).agg(F.count(F.lit(1)).alias("n")), "seen")
    tables.drop_table(spark, name)
    return rows


@query
def partition_registration(spark, sf):
    name = _items_table(spark, _items_by_flag(spark, sf))
    tables.add_partitions(spark, name)
    return _partitions_seen(spark, name)


@query
def refresh_partitions(spark, sf):
    name = _items_table(spark, _items_by_flag(spark, sf))
    tables.refresh_partitions(spark, name)
    return _partitions_seen(spark, name)


@query
def catalog_partitions(spark, sf):
    """Partitions of a catalog table that match some values."""
    name = _items_table(spark, _items_by_flag(spark, sf))
    tables.add_partitions(spark, name)
    found = written(tables.matching_partitions(spark, name, {"l_linestatus": "F"}), "matching")
    tables.drop_table(spark, name)
    return found


@query
def table_lifecycle(spark, sf):
    """Rows of a table after it is made twice and filled, after truncation, and whether it is there
    after it is dropped."""
    name = _named("life")
    for _ in range(2):
        tables.ensure_table(spark, name, "o_orderkey bigint, o_custkey bigint")
    table(spark, sf, "orders").select("o_orderkey", "o_custkey").write.insertInto(name)
    filled = spark.table(name).count()
    tables.truncate_table(spark, name)
    emptied = spark.table(name).count()
    tables.drop_table(spark, name)
    return spark.createDataFrame(
        [(filled, emptied, spark.catalog.tableExists(name))], "filled long, emptied long, there boolean"
    )


def _table_sink(spark, sf, fmt, **options):
    """Good rows appended through a table sink in two batches, the second of them twice."""
    name = _named("sink")
    columns = "from_key string, to_key string, total bigint, object_key string"
    tables.ensure_table(spark, name, columns, ["to_key"], fmt, scratch_path(spark, name), **options)
    write = sinks.build_sink(spark, SinkSpec("HIVE", {"table": name}, "job"), EDGE_MIX)
    checked = quality.validate(messages(spark, sf), EDGE_MIX, keep=["event_id"])
    rows = quality.clean_rows(checked, keep=["event_id"])
    half = F.col("event_id") % 2
    for number in (0, 1, 1):
        write(rows.where(half == number), number)
    tables.add_partitions(spark, name)
    found = written(spark.table(name), "sunk")
    tables.drop_table(spark, name)
    return found


@query
def table_sink_parquet(spark, sf):
    return _table_sink(spark, sf, "parquet")


@query
def table_sink_orc(spark, sf):
    return _table_sink(spark, sf, "orc")


@query
def table_sink_text(spark, sf):
    return _table_sink(spark, sf, "csv", sep="|")


@query
def parquet_readback(spark, sf):
    """Every column of a table through Parquet files."""
    path = scratch_path(spark, "parquet")
    table(spark, sf, "orders").write.parquet(path)
    return spark.read.parquet(path).withColumn("o_orderdate", _day("o_orderdate"))


@query
def orc_readback(spark, sf):
    """Every column of a table through ORC files."""
    path = scratch_path(spark, "orc")
    table(spark, sf, "orders").write.orc(path)
    return spark.read.orc(path).withColumn("o_orderdate", _day("o_orderdate"))


@query
def user_sink(spark, sf):
    """Good rows through a sink of the user's own."""
    path = scratch_path(spark, "user-sink")

    def factory(_spark, spec, _schema):
        return lambda rows, number: rows.write.mode("overwrite").parquet(f"{spec.options['path']}/{number}")

    sinks.register_sink("PLAIN_FILES", factory)
    write = sinks.build_sink(spark, SinkSpec("PLAIN_FILES", {"path": path}), EDGE_MIX)
    rows = quality.clean_rows(quality.validate(messages(spark, sf), EDGE_MIX, keep=["event_id"]), keep=["event_id"])
    for _ in range(2):
        write(rows.select("event_id", "object_key", "total"), 3)
    return spark.read.parquet(f"{path}/3")


@query
def replayed_batches(spark, sf):
    """The change log in batches of two jobs: one batch comes twice, and the second job begins to
    count at 0."""
    start = _target(spark, sf)
    stored = KeyedTable(spark, scratch_path(spark, "replayed"), start.schema, ["c_custkey"], buckets=8)
    stored.apply(start.withColumn("event_id", F.lit(0)), "event_id", 0, job="first")
    log = _log(spark, sf, keys.run_of(F.col("event_id"), 2))
    third = F.col("event_id") * 3 >= F.lit(log.count())
    two_thirds = F.col("event_id") * 3 >= F.lit(2 * log.count())
    batches = [("first", 1, ~third), ("first", 1, ~third), ("second", 0, third & ~two_thirds), ("second", 1, two_thirds)]
    for number, (job, batch, part) in enumerate(batches):
        stored.apply(log.where(part), "event_id", batch, _is_delete(), job=job)
        if number == 1:
            stored.fold()
    return stored.read()


@query
def compacted_evolved(spark, sf):
    """lineitem written in two parts, one with more columns, and merged."""
    path = scratch_path(spark, "evolved")
    rows = table(spark, sf, "lineitem")
    odd = F.col("l_orderkey") % 2 == 1
    rows.where(odd).drop("l_tax", "l_shipdate").repartition(5).write.parquet(path)
    rows.where(~odd).repartition(5).write.mode("append").parquet(path)
    compaction.compact(spark, path, policy=RollingPolicy(enabled=True, max_part_bytes=150_000, rollover_seconds=0))
    return compaction.read_table(spark, path).withColumn("l_shipdate", _day("l_shipdate"))


@query
def ingest_partitions(spark, sf):
    """Changes of a key from several partitions of a topic, put in order by time."""
    from millrace.operators import changes
    from millrace.sources.readers import KAFKA_POSITION

    events = table(spark, sf, "events")
    placed = events.select(
        F.col("ts").alias("timestamp"), F.lit("events").alias("topic"), (F.col("event_id") * 7 % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), "user_id", "value",
    )
    ordered = placed.withColumn("_seq", sinks.sequence_of(placed, list(KAFKA_POSITION)))
    return changes.latest_per_key(ordered, ["user_id"], "_seq").select("user_id", "partition", "offset", "value")


def _job(spark, sf):
    """A loading job on a stream of messages, run to its end: the job, and where it writes."""
    base = scratch_path(spark, "job")
    messages(spark, sf).write.json(f"{base}/in")
    config = {
        "errorInfo": {
            "dirtyData": {"storeType": "file", "storeEnabled": True, "storeRowsLimit": 1_000_000,
                          "taskInstanceId": "load-1", "config": {"path": f"{base}/dirty"}},
            "logInfo": {"storeType": "file", "config": {"path": f"{base}/log"}},
        },
        "taskConfig": {"checkPoint": f"{base}/checkpoint", "restart": 0},
        "schema": {
            "fields": [
                {"sourceName": "$.from_key", "targetName": "object_key", "type": "STRING", "isMain": "Y"},
                {"sourceName": "$.reading.amount", "targetName": "total", "type": "LONG", "isMain": "Y"},
                {"sourceName": "$._operation", "targetName": "_operation", "type": "STRING", "isMain": "Y"},
            ],
            "name": "users", "type": "vertex", "operation": {"mode": "MIX", "operateField": "_operation"},
        },
        "sinks": [{"storeType": "ES", "storeConfig": {"url": "none", "index": "users", "type": "u", "path": f"{base}/es",
                                                      "buckets": 8}}],
        "sources": [{"storeType": "json", "storeConfig": {"path": f"{base}/in"}}],
    }
    work = Ingest(spark, JobSpec.from_config(json.dumps(config)), position=["event_id"], clock=lambda: START)
    stream = spark.readStream.schema("event_id long, user_id long, value string").json(f"{base}/in")
    work.run(stream, available_now=True)
    return work, base


@query
def stream_ingest(spark, sf):
    """What a job on a stream leaves in its sink."""
    work, _ = _job(spark, sf)
    return work.sinks[0].table.read().select("id", "object_key", "total")


@query
def stream_totals(spark, sf):
    totals = _job(spark, sf)[0].ledger.totals()
    return spark.createDataFrame(
        [(totals.consumed, totals.dirty, totals.stored_dirty)], "consumed long, dirty long, stored_dirty long"
    )


@query
def dirty_files(spark, sf):
    """Bad rows of a job as its files hold them, by kind."""
    lines = spark.read.text(f"{_job(spark, sf)[1]}/dirty/2024-02-01/dirty-*")
    kind = F.get_json_object("value", "$.error_type").alias("error_type")
    return lines.groupBy(kind, F.get_json_object("value", "$.task_instance_id").alias("task")).agg(F.count(F.lit(1)).alias("n"))


@query
def error_log(spark, sf):
    """The error of a job that counted too many bad rows."""
    path = scratch_path(spark, "log")
    bad = quality.validate(messages(spark, sf), EDGE_MIX, keep=["event_id"]).where("error is not null").count()
    for text in ("first failure", f"DIRTY_COUNT_ERROR##{bad} bad rows"):
        sinks.write_error_log(spark, path, text, "load-1", START)
    line = spark.read.text(f"{path}/2024-02-01/error.log")
    names = ["task_instance_id", "error_type", "error_log", "updated_dt"]
    return line.select(*[F.get_json_object("value", f"$.{n}").alias(n) for n in names])


@query
def stream_windows(spark, sf):
    """Whole windows of a stream of events."""
    path, source = scratch_path(spark, "windows"), scratch_path(spark, "events")
    table(spark, sf, "events").write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    lists = tumbling_window(stream, "ts", "10 seconds", "user_id", "event_id", ["event_type"], watermark="1 minute")
    run = (
        lists.writeStream.outputMode("complete").trigger(availableNow=True)
        .option("checkpointLocation", f"{path}/checkpoint")
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{path}/out"))
        .start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{path}/out").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", F.array_join("rows", ",").alias("users")
    )

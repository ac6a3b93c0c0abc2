"""Queries over state, sinks and counters of streams, and over layouts that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import keys
from millrace.operators import layout, lookup, profile
from millrace.session import scratch_path, written
from millrace.sources import tasksink
from millrace.sources.bucketed import BucketedTable
from millrace.streaming import files, progress, state

from .messages import EDGE_MIX, messages, table
from .queries import _is_delete, _log, _target, query
from .stores import FLAGS, _named

PARTS = 3


def _arriving(spark, rows: DataFrame, order: str | Column, closing: DataFrame | None = None, late: DataFrame | None = None):
    """The rows as a stream that brings a third at a time, in order, then late rows and a closing one."""
    path = scratch_path(spark, "arriving")
    order = F.col(order) if isinstance(order, str) else order
    low, high = rows.agg(F.min(order), F.max(order)).first()
    place = F.least(F.floor((order - F.lit(low)) * PARTS / F.lit(high - low + 1)), F.lit(PARTS - 1))
    for number in range(PARTS):
        rows.where(place == number).coalesce(1).write.mode("append").parquet(path)
    for extra in (late, closing):
        if extra is not None:
            extra.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path), path


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _closing(rows: DataFrame):
    """One row long after the others, whose key is no one's; it moves the watermark over all of them."""
    last = rows.agg(F.max("ts").alias("last"))
    one = last.select((F.col("last") + F.expr("INTERVAL 10 DAYS")).alias("ts"))
    return one.select(*[F.col("ts") if c == "ts" else F.lit(-1).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])


@query
def stream_keyed_buffers(spark, sf):
    """Events in the buffers of their users: a buffer opens with a user's first event and is released an hour
    later; the next event opens the next."""
    events = _events(spark, sf).select("event_id", "ts", "user_id")
    # By time, as numbers of events need not rise with it; else rows would come behind the watermark.
    stream, path = _arriving(spark, events, F.unix_micros("ts"), _closing(events))
    with state.rocksdb(spark):
        held = state.keyed_buffers(stream, ["user_id"], "ts", 3600, ["event_id"], late="10 minutes", groups=1024)
        files.append_files(held, f"{path}-out", f"{path}-checkpoint", available_now=True).awaitTermination()
    return files.appended(spark, f"{path}-out").select("user_id", "event_id", "opened_us")


@query
def state_totals(spark, sf):
    """Totals of each user in the state of a stream that was stopped after each batch but the last."""
    rows = messages(spark, sf).select("event_id", "user_id")
    path = scratch_path(spark, "totals")
    with state.rocksdb(spark):
        for number in range(PARTS):
            rows.where(F.col("event_id") % PARTS == number).write.mode("append").parquet(f"{path}/in")
            stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
            totals = state.keyed_totals(stream, "user_id", F.col("event_id") % 10 < 3)
            run = totals.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{path}/checkpoint")
            run.trigger(availableNow=True).start().awaitTermination()
        return written(state.stored_totals(spark, f"{path}/checkpoint"), "totals")


@query
def stream_windows_closed(spark, sf):
    """Windows that a stream gave when it closed them, in append mode; rows that came too late are not in them."""
    events = _events(spark, sf)
    first = events.agg(F.min("ts")).first()[0]
    late = events.where(F.col("ts") < F.lit(first) + F.expr("INTERVAL 1 MINUTE")).withColumn("event_id", -F.col("event_id") - 1)
    stream, path = _arriving(spark, events, "event_id", _closing(events), late)
    lists = files.closed_windows(stream, "ts", "10 seconds", "user_id", "event_id", ["event_type"], "1 minute")
    files.append_files(lists, f"{path}-out", f"{path}-checkpoint", available_now=True).awaitTermination()
    found = files.appended(spark, f"{path}-out")
    return found.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", F.array_join("rows", ",").alias("users")
    )


@query
def stream_file_sink(spark, sf):
    """Good rows appended to partitioned files by a stream that is stopped and started again twice."""
    path, rows = scratch_path(spark, "file-sink"), messages(spark, sf)
    for number in range(PARTS):
        rows.where(F.col("event_id") % PARTS == number).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        good = files.checked_rows(stream, EDGE_MIX, keep=["event_id"]).select("event_id", "from_key", "total", "to_key")
        files.append_files(good, f"{path}/out", f"{path}/checkpoint", partition_by=["to_key"], available_now=True).awaitTermination()
    return files.appended(spark, f"{path}/out").select("event_id", "from_key", "total", "to_key")


@query
def datasource_sink(spark, sf):
    """Good rows through a sink that writes from tasks: a stream, and a table's write that is repeated."""
    path, name = scratch_path(spark, "task-sink"), _named("store")
    tasksink.register_task_sink(spark, name, tasksink.FileStore)
    rows = messages(spark, sf)
    even = F.col("event_id") % 2 == 0
    rows.where(even).write.parquet(f"{path}/in")
    kept = ["event_id", "object_key", "total"]
    stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
    good = files.checked_rows(stream, EDGE_MIX, keep=["event_id"]).select(*kept)
    run = good.writeStream.format(name).option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
    run.trigger(availableNow=True).start().awaitTermination()
    odd = files.checked_rows(rows.where(~even), EDGE_MIX, keep=["event_id"]).select(*kept)
    for _ in range(2):
        odd.write.format(name).mode("append").options(path=f"{path}/out", batch="odd").save()
    return tasksink.FileStore({"path": f"{path}/out"}).read(spark, good.schema)


@query
def progress_counts(spark, sf):
    """Messages and bad ones of each batch, from the progress of the query that read them."""
    stream, path = _arriving(spark, messages(spark, sf), "event_id")
    bad = F.col("event_id") % 10 < 3
    run = progress.counted(stream, bad).writeStream.format("noop").option("checkpointLocation", f"{path}-checkpoint")
    run = run.trigger(availableNow=True).start()
    run.awaitTermination()
    rows = [(told["batch"], told["consumed"], told["dirty"], sum(c for c, _ in told["tasks"].values())) for told in progress.counts(run)]
    return spark.createDataFrame(rows, "batch long, consumed long, dirty long, by_tasks long")


@query
def bucketed_merge(spark, sf):
    """The change log applied to a bucketed table in three batches, the middle one twice."""
    start, name = _target(spark, sf), _named("bucketed")
    stored = BucketedTable(spark, name, start.schema, ["c_custkey"], partitions=8, buckets=4, path=scratch_path(spark, name))
    stored.apply(start.withColumn("event_id", F.lit(0)), "event_id")
    log = _log(spark, sf, keys.run_of(F.col("event_id"), 2))
    n = log.count()
    third, two_thirds = F.col("event_id") * 3 >= F.lit(n), F.col("event_id") * 3 >= F.lit(2 * n)
    middle = log.where(third & ~two_thirds)
    for batch in (log.where(~third), middle, middle, log.where(two_thirds)):
        stored.apply(batch, "event_id", delete=_is_delete())
    found = written(stored.read(), "bucketed")
    spark.sql(f"DROP TABLE {name}")
    return found


@query
def pruned_lookup(spark, sf):
    """Rows of the partitions that another table's rows name."""
    path = scratch_path(spark, "items")
    layout.write_partitioned(table(spark, sf, "lineitem"), path, FLAGS)
    wanted = table(spark, sf, "lineitem").where("l_quantity = 50 AND l_returnflag <> 'N'").select(*FLAGS)
    found = lookup.rows_of_partitions(spark.read.parquet(path), written(wanted.distinct(), "wanted"), FLAGS)
    return found.groupBy(*FLAGS).agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"))


@query
def profile_json_fields(spark, sf):
    """Kinds of values below the paths of event messages."""
    paths = ["$.from_key", "$.reading.amount", "$.reading.share", "$.object_key", "$.s", "$.none"]
    return profile.profile_json_fields(messages(spark, sf), "value", paths)

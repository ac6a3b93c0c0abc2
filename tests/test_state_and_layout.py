"""State per key, closing windows, Spark's own sinks, counters, bucketed tables, pruning, JSON profiles."""

import os
import random
import uuid
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from __spark_entry__ import queries
from conftest import SF
from millrace.operators import lookup, profile
from millrace.operators.changes import apply_batch, upsert_patch
from millrace.plans import compaction
from millrace.session import scratch_path, written
from millrace.sources.bucketed import PART, BucketedTable
from millrace.sources.sinks import SEQ, build_sink
from millrace.sources.tasksink import FileStore, register_task_sink
from millrace.spec import FieldSpec, SchemaSpec, SinkSpec
from millrace.streaming import files, progress, state

EVENTS = "user long, seq long, ts timestamp, note string"


def as_events(spark, rows):
    typed = spark.createDataFrame([(u, s, us, n) for u, s, us, n in rows], "user long, seq long, us long, note string")
    return typed.select("user", "seq", F.timestamp_micros("us").alias("ts"), "note")


def arriving(spark, *parts):
    path = scratch_path(spark, "arriving")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def plain_buffers(rows, length):
    opened, out = {}, []
    for user, seq, us, _ in sorted(rows, key=lambda r: r[2]):
        if user not in opened or us >= opened[user] + length:
            opened[user] = us
        out.append((user, seq, opened[user]))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(2))
def test_buffers_open_with_the_first_row_and_close_later(spark, seed):
    draw = random.Random(seed)
    minute = 60_000_000
    rows = [(draw.choice([1, 2, 3, None]), i, i * minute // 2 + draw.randrange(minute * 3), draw.choice(["a", None])) for i in range(300)]
    parts = [rows[:100], rows[100:101], rows[101:200], rows[200:]]
    closing = [(-9, -1, 10**12, None)]
    stream = arriving(spark, *[as_events(spark, p) for p in (*parts, closing)])
    path = scratch_path(spark, "buffers")
    with state.rocksdb(spark):
        held = state.keyed_buffers(stream, ["user"], "ts", 600, ["seq", "note"], late="5 minutes")
        run = files.append_files(held, f"{path}/out", f"{path}/checkpoint", available_now=True)
        run.awaitTermination()
    found = files.appended(spark, f"{path}/out").collect()
    assert sorted(((r["user"], r["seq"], r["opened_us"]) for r in found), key=str) == plain_buffers(rows, 600_000_000)
    assert {(r["seq"], r["note"]) for r in found} == {(s, n) for _, s, _, n in rows}
    # What is released leaves the state.
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]]
    assert kept[-1] < max(kept)


class _State:
    """A key's state in memory, whose calls are counted."""

    def __init__(self):
        self.calls, self.timers, self.stored = 0, set(), {}

    def getListState(self, name, schema):
        return _Stored(self, name)

    getValueState = getListState

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


class _Stored:
    def __init__(self, handle, name):
        self.handle, self.name = handle, name

    def exists(self):
        self.handle.calls += 1
        return self.name in self.handle.stored

    def get(self):
        self.handle.calls += 1
        return self.handle.stored.get(self.name)

    def update(self, value):
        self.handle.calls += 1
        self.handle.stored[self.name] = value

    put = update

    def appendList(self, values):
        self.update([*self.handle.stored.get(self.name, []), *values])

    def clear(self):
        self.handle.calls += 1
        self.handle.stored.pop(self.name, None)


def test_a_key_with_many_buffers_costs_few_calls_and_one_frame():
    minute = 60_000_000
    handle, clock = _State(), SimpleNamespace(getCurrentWatermarkInMs=lambda: 950 * 1200_000)
    long = [T.StructField(name, T.LongType()) for name in ("user", "seq")]
    held = state._Buffers(long[:1], long[1:], 10 * minute, True)
    held.init(handle)
    rows = pd.DataFrame({"at_us": [i * 20 * minute for i in range(1000)], "seq": [None, *range(1, 1000)]})
    list(held.handleInputRows((1,), iter([rows[500:], rows[:500]]), clock))
    frames = list(held.handleExpiredTimer((1,), clock, None))
    assert len(frames) == 1 and handle.calls < 20
    assert frames[0]["seq"].tolist() == [None, *range(1, 950)]
    assert frames[0]["opened_us"].tolist() == rows["at_us"][:950].tolist()
    # Fifty wait for the next timer.
    assert (handle.stored["opened"], len(handle.stored["rows"][0][0])) == ((950 * 20 * minute,), 50)
    assert max(handle.timers) == (950 * 20 + 10) * 60_000


def test_keys_that_share_a_state_give_the_same_buffers(spark):
    draw, minute = random.Random(5), 60_000_000
    rows = [(draw.choice([1, 2, 3, 4, None]), i, i * minute // 2 + draw.randrange(minute * 3), draw.choice(["a", None])) for i in range(300)]
    stream = arriving(spark, *[as_events(spark, p) for p in (rows[:100], rows[100:101], rows[101:], [(-9, -1, 10**12, None)])])
    path = scratch_path(spark, "shared")
    with state.rocksdb(spark):
        held = state.keyed_buffers(stream, ["user", "note"], "ts", 600, ["seq"], late="5 minutes", groups=2)
        files.append_files(held, f"{path}/out", f"{path}/checkpoint", available_now=True).awaitTermination()
    found = [((r["user"], r["note"]), r["seq"], r["opened_us"]) for r in files.appended(spark, f"{path}/out").collect()]
    assert sorted(found, key=str) == plain_buffers([((u, n), i, us, n) for u, i, us, n in rows], 600_000_000)
    with pytest.raises(ValueError):
        state.keyed_buffers(stream.withColumn("user", F.col("user") / 2), ["user"], "ts", 600, ["seq"], groups=2)


def test_buffers_of_events_whose_numbers_do_not_follow_time(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").where("event_id < 200")
    shifted = [events.withColumns({"event_id": F.col("event_id") + i * 200, "user_id": F.col("user_id") % 5}) for i in range(3)]
    shifted[0].unionAll(shifted[1]).unionAll(shifted[2]).write.parquet(str(tmp_path / "events.parquet"))
    stored = spark.read.parquet(str(tmp_path / "events.parquet"))
    rows = [(r["user_id"], r["event_id"], r["us"], None) for r in stored.selectExpr("*", "unix_micros(CAST(ts AS TIMESTAMP)) AS us").collect()]
    found = queries()["stream_keyed_buffers"](spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_buffers(rows, 3_600_000_000)


def test_buffers_by_the_clock(spark):
    stream = arriving(spark, as_events(spark, [(1, 1, 0, "a"), (1, 2, 10**15, "b"), (2, 3, 5, None)]))
    path = scratch_path(spark, "clock")
    with state.rocksdb(spark):
        held = state.keyed_buffers(stream, ["user"], "ts", 0.5, ["seq"], event_time=False)
        run = files.append_files(held, f"{path}/out", f"{path}/checkpoint", every="300 milliseconds")
        for _ in range(60):
            run.awaitTermination(0.5)
            if os.path.exists(f"{path}/out/_spark_metadata") and files.appended(spark, f"{path}/out", schema=held.schema).count() == 3:
                break
        run.stop()
    found = files.appended(spark, f"{path}/out", schema=held.schema).collect()
    assert sorted((r["user"], r["seq"]) for r in found) == [(1, 1), (1, 2), (2, 3)]
    assert len({r["opened_us"] for r in found if r["user"] == 1}) == 1


def test_totals_survive_a_stop(spark):
    path = scratch_path(spark, "totals")
    rows = spark.range(90).selectExpr("id % 7 AS user", "id")
    with state.rocksdb(spark):
        for low in (0, 30, 60):
            rows.where(f"id >= {low} AND id < {low + 30}").write.mode("append").parquet(f"{path}/in")
            totals = state.keyed_totals(spark.readStream.schema(rows.schema).parquet(f"{path}/in"), "user", F.col("id") < 40)
            run = totals.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{path}/c")
            run.trigger(availableNow=True).start().awaitTermination()
        got = {r["key"]: (r["consumed"], r["dirty"]) for r in state.stored_totals(spark, f"{path}/c").collect()}
    assert got == {str(u): (len(range(u, 90, 7)), len(range(u, 40, 7))) for u in range(7)}


def test_windows_close_once_and_late_rows_are_counted(spark):
    second = 1_000_000
    early, later = [(1, i, i * second, "x") for i in range(60)], [(1, i, i * second, "x") for i in range(600, 660)]
    late = [(1, 1000 + i, i * second, "x") for i in range(5)]
    stream = arriving(spark, *[as_events(spark, p) for p in (early, later, late, [(2, 0, 10**11, "x")])])
    path = scratch_path(spark, "closed")
    lists = files.closed_windows(stream, "ts", "10 seconds", "seq", "seq", ["user"], "30 seconds")
    run = files.append_files(lists, f"{path}/out", f"{path}/checkpoint", available_now=True)
    run.awaitTermination()
    rows = [r["rows"] for r in files.appended(spark, f"{path}/out").orderBy("window_start").collect()]
    assert rows == [list(range(s, s + 10)) for s in (*range(0, 60, 10), *range(600, 660, 10))]
    told = [p["stateOperators"][0] for p in run.recentProgress if p["stateOperators"]]
    assert sum(t["numRowsDroppedByWatermark"] for t in told) > 0
    assert told[-1]["numRowsTotal"] == 1 < max(t["numRowsTotal"] for t in told)


def test_file_sink_leaves_a_repeated_batch_once(spark):
    path = scratch_path(spark, "again")
    rows = spark.range(100).selectExpr("id", "id % 3 AS part")
    for number in range(2):
        rows.where(F.col("id") % 2 == number).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        files.append_files(stream, f"{path}/out", f"{path}/checkpoint", partition_by=["part"], available_now=True).awaitTermination()
    # The stream stopped after its last batch was written and before it was noted as done.
    commits = f"{path}/checkpoint/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
    files.append_files(stream, f"{path}/out", f"{path}/checkpoint", partition_by=["part"], available_now=True).awaitTermination()
    assert sorted(r["id"] for r in files.appended(spark, f"{path}/out").collect()) == list(range(100))
    # A file that no batch names is not seen.
    spark.range(5).selectExpr("id + 1000 AS id").coalesce(1).write.mode("append").parquet(f"{path}/out/part=0")
    assert files.appended(spark, f"{path}/out").count() == 100


def test_task_sink_shows_whole_batches_only(spark):
    path, name = scratch_path(spark, "store"), f"store_{uuid.uuid4().hex}"
    register_task_sink(spark, name, FileStore)
    rows = spark.range(0, 40, 1, 4).toDF("id")
    store = FileStore({"path": path})
    write = lambda df, batch: df.write.format(name).mode("append").options(path=path, batch=batch).save()
    assert store.read(spark, rows.schema).count() == 0
    write(rows, "a")
    write(rows, "a")
    assert sorted(r["id"] for r in store.read(spark, rows.schema).collect()) == list(range(40))
    broken = rows.select(F.when(F.col("id") == 35, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        write(broken, "b")
    assert store.read(spark, rows.schema).count() == 40
    write(rows.where("id < 0"), "c")
    assert store.read(spark, rows.schema).count() == 40


def test_counters_come_with_the_progress(spark):
    rows = spark.range(100).withColumn("bad", F.when(F.col("id") % 4 == 0, True))
    stream = arriving(spark, rows.where("id < 30"), rows.where("id >= 30"))
    told = []
    listener = progress.CounterListener(tell=told.append)
    spark.streams.addListener(listener)
    try:
        run = progress.counted(stream, F.col("bad")).writeStream.format("noop").trigger(availableNow=True)
        run = run.option("checkpointLocation", scratch_path(spark, "c")).start()
        run.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    finally:
        spark.streams.removeListener(listener)
    counts = progress.counts(run)
    assert [(c["consumed"], c["dirty"]) for c in counts] == [(30, 8), (70, 17)]
    assert all(sum(n for n, _ in c["tasks"].values()) == c["consumed"] for c in counts)
    assert (listener.consumed, listener.dirty) == (100, 25) and len(told) == 2


CUSTOMERS = "id long, name string, city string"


def bucketed(spark, patch=False, partitions=4):
    name = f"b_{uuid.uuid4().hex}"
    made = BucketedTable(spark, name, spark.createDataFrame([], CUSTOMERS).schema, ["id"], partitions, 4, patch, scratch_path(spark, name))
    first = spark.range(200).selectExpr("id", "'n' || id AS name", "'c' AS city", "0L AS seq")
    made.apply(first, "seq")
    return made


def test_merges_leave_stored_rows_where_they_are(spark):
    table = bucketed(spark)
    changes = spark.range(150, 250).selectExpr("id", "'new' AS name", "'d' AS city", "id AS seq", "id % 5 = 0 AS gone")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        batch = written(table.reduced(changes, "seq", F.col("gone"), "sequence"), "batch")
        plan = table.merged(batch, range(4))._jdf.queryExecution().executedPlan().toString()
        stored = plan[plan.index("SortMergeJoin"):]
        side = stored[: stored.index("_gone")] if "_gone" in stored else stored
        assert "Bucketed: true" in plan and plan.count("SortMergeJoin") == 1
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
        assert not any("Exchange" in line for line in lines[join:scan]), side
        table.apply(changes, "seq", delete=F.col("gone"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = {r["id"]: r["name"] for r in table.read().collect()}
    assert got == {i: "new" if i >= 150 else f"n{i}" for i in range(250) if i < 150 or i % 5}


@pytest.mark.parametrize("patch", [False, True])
def test_bucketed_table_is_what_the_merges_give(spark, patch):
    table, draw = bucketed(spark, patch), random.Random(3)
    want = table.read().withColumn("city", F.col("city"))
    for number in range(3):
        data = [(draw.randrange(260), draw.choice(["x", None]), draw.choice(["y", None]), s, draw.random() < 0.3) for s in range(120)]
        changes = spark.createDataFrame(data, f"{CUSTOMERS}, seq long, gone boolean")
        merge = upsert_patch if patch else apply_batch
        want = written(merge(want, changes, ["id"], "seq", F.col("gone")), "want")
        for _ in range(2):  # a batch that comes again changes nothing
            table.apply(changes, "seq", delete=F.col("gone"))
    assert sorted(map(tuple, table.read().collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_only_touched_partitions_are_written_and_emptied_ones_go(spark):
    table = bucketed(spark)
    ids = {p: [r["id"] for r in spark.table(table.name).where(F.col(PART) == p).collect()] for p in range(4)}
    places = lambda: {r[0]: r[1] for r in spark.table(table.name).select(PART, F.input_file_name().alias("f")).distinct().groupBy(PART).agg(F.sort_array(F.collect_list("f"))).collect()}
    before = places()
    gone = spark.createDataFrame([(i, None, None, 1) for i in ids[2]], f"{CUSTOMERS}, seq long")
    table.apply(gone, "seq", delete=F.lit(True))
    after = places()
    assert 2 not in after and all(after[p] == before[p] for p in (0, 1, 3))
    assert not table.apply(gone.limit(0), "seq")
    again = BucketedTable(spark, table.name, table.schema, ["id"], 99, 99)
    assert (again.partitions, again.buckets) == (4, 4)


def test_a_keyed_sink_on_a_bucketed_table(spark):
    schema = SchemaSpec(fields=(FieldSpec("$.object_key", "object_key", "STRING", True), FieldSpec("$.n", "n", "LONG", False)),
                        kind="vertex", mode="UPSERT")
    name = f"sink_{uuid.uuid4().hex}"
    sink = build_sink(spark, SinkSpec("ES", {"index": "i", "type": "t", "bucketedTable": name, "buckets": 4, "tablePartitions": 2}), schema)
    for batch, value in enumerate((1, 2)):
        sink(spark.range(10).selectExpr("'k' || id AS object_key", f"id * {value} AS n", f"id AS {SEQ}"), batch)
    sink.upkeep()
    assert {(r["id"], r["n"]) for r in spark.table(name).collect()} == {(f"k{i}", 2 * i) for i in range(10)}


def test_lookups_by_values_prune_partitions(spark):
    path = scratch_path(spark, "pruned")
    spark.range(1000).selectExpr("id", "id % 20 AS part").write.partitionBy("part").parquet(path)
    wanted = written(spark.createDataFrame([(3, "a"), (3, "b"), (5, "c"), (77, "d")], "part long, why string"), "wanted")
    found = lookup.rows_of_partitions(spark.read.parquet(path), wanted.where("why <> 'z'"), ["part"])
    rows = found.collect()
    assert len(rows) == 100 and {r["part"] for r in rows} == {3, 5}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_json_fields_of_mixed_rows(spark):
    texts = ['{"a": 1, "b": {"c": "x"}}', '{"a": 2.5, "b": null}', '{"a": true}', "no json", None, "[1]", '{"a": "1"}']
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    whole = profile.json_fields(rows, "value").first()
    assert (whole["rows"], whole["valid"]) == (6, 5)
    got = {r["path"]: tuple(r)[1:] for r in profile.profile_json_fields(rows, "value", ["$.a", "$.b.c", "$.z"]).collect()}
    assert got == {"$.a": (4, 1, 1, 1, 1), "$.b.c": (1, 0, 0, 1, 0), "$.z": (0, 0, 0, 0, 0)}
    empty = profile.profile_json_fields(rows.limit(0), "value", ["$.a"]).collect()
    assert [tuple(r) for r in empty] == [("$.a", 0, 0, 0, 0, 0)]


def test_a_table_of_files_with_different_columns_is_read_whole(spark):
    path = scratch_path(spark, "evolved")
    spark.sql("SELECT 1 AS a, 2 AS b").coalesce(1).write.parquet(path)
    spark.sql("SELECT 3 AS a, 4 AS b, 5 AS c").coalesce(1).write.mode("append").parquet(path)
    found = compaction.read_table(spark, path)
    assert found.columns == ["a", "b", "c"] and sorted(map(tuple, found.collect())) == [(1, 2, None), (3, 4, 5)]

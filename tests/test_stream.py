"""The loading job on streams: sinks, bad rows, totals, repeats and limits."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace.operators.quality import DirtyLimitExceeded
from millrace.plans import commit
from millrace.session import scratch_path
from millrace.sources import tables
from millrace.sources.readers import number_lines, read_source, read_text_stream
from millrace.sources.sinks import build_sink, error_record, keyed_location, register_sink, write_error_log
from millrace.spec import JobSpec, SinkSpec, SourceSpec, SpecError
from millrace.streaming.ingest import Ingest, Upkeep, ingest_rows
from millrace.streaming.windows import tumbling_window

START = datetime(2024, 1, 31, 23, 59, tzinfo=timezone.utc)


def config(spark, **changes):
    base = scratch_path(spark, "job")
    text = {
        "errorInfo": {
            "dirtyData": {
                "storeType": "file", "handleMode": -1, "storeEnabled": True, "storeRowsLimit": 5,
                "taskInstanceId": "load-1", "config": {"path": f"{base}/dirty"},
            },
            "logInfo": {"storeType": "file", "config": {"path": f"{base}/log"}},
        },
        "taskConfig": {"checkPoint": f"{base}/checkpoint", "restart": 1},
        "schema": {
            "fields": [
                {"sourceName": "$.object_key", "targetName": "object_key", "type": "STRING", "isMain": "Y"},
                {"sourceName": "$.person.age", "targetName": "age", "type": "LONG", "isMain": "N"},
                {"sourceName": "$.name", "targetName": "name", "type": "STRING"},
                {"sourceName": "$.country", "targetName": "country", "type": "STRING"},
                {"sourceName": "$._operation", "targetName": "_operation", "type": "STRING", "isMain": "Y"},
            ],
            "name": "people", "type": "vertex", "operation": {"mode": "MIX", "operateField": "_operation"},
        },
        "sinks": [
            {"storeType": "ES", "storeConfig": {"url": "none", "index": "people", "type": "p", "path": f"{base}/es",
                                                "payloadPath": f"{base}/bulk", "buckets": 4}},
            {"storeType": "GDB", "storeConfig": {"url": "none", "user": "u", "password": "p", "database": "d",
                                                 "collection": "c", "path": f"{base}/gdb", "buckets": 4}},
            {"storeType": "HBASE", "storeConfig": {"url": "none", "table": "t", "path": f"{base}/hbase", "buckets": 4}},
        ],
        "sources": [{"storeType": "text", "storeConfig": {"path": f"{base}/in"}}],
    }
    text.update(changes)
    return base, text


def message(key, op="ADD", age=None, name=None, country=None):
    body = {"object_key": key, "_operation": op, "person": {"age": age}, "name": name, "country": country}
    return json.dumps({k: v for k, v in body.items() if v is not None})


def put(spark, base, *lines):
    spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.mode("append").text(f"{base}/in")


def stored(work, number):
    """The rows of a job's keyed sink."""
    sink = work.sinks[number]
    return getattr(sink, "keyed", sink).table.read()


def test_job_on_a_stream(spark):
    base, text = config(spark)
    job = JobSpec.from_config(text)
    put(spark, base, message("1", name="Ann", age="30.5", country="x"), message("2", name="Bob"), "broken",
        message("3", op="INSERT"))
    work = Ingest(spark, job, clock=lambda: START)
    work.run(available_now=True)
    put(spark, base, message("1", op="UPDATE", age=31), message("2", op="DELETE"), message("4", name="Dan"),
        message("5/6"))
    Ingest(spark, job, clock=lambda: START + timedelta(days=1)).run(available_now=True)

    documents = {r["id"]: (r["name"], r["age"]) for r in stored(work, 0).collect()}
    assert documents == {"1": (None, 31), "4": ("Dan", None)}
    graph = {r["_key"]: (r["name"], r["age"], r["country"]) for r in stored(work, 1).collect()}
    assert graph == {"1": ("Ann", 31, "x"), "4": ("Dan", None, None)}
    wide = stored(work, 2)
    assert {r["_row_key"].split("#")[1] for r in wide.collect()} == {"1", "4"} and "_operation" not in wide.columns

    totals = work.ledger.totals()
    assert (totals.batch_id, totals.consumed, totals.dirty, totals.stored_dirty) == (1, 8, 3, 3)
    days = {d: spark.read.text(f"{base}/dirty/{d}/dirty-*").collect() for d in ("2024-01-31", "2024-02-01")}
    kinds = sorted(json.loads(r["value"])["error_type"] for r in days["2024-01-31"])
    assert kinds == ["CHECK_DIRTY_ERROR", "PARSE_ERROR"] and len(days["2024-02-01"]) == 1
    envelope = json.loads(days["2024-02-01"][0]["value"])
    assert envelope["affected_store"] == "ES,GDB,HBASE" and envelope["task_instance_id"] == "load-1"
    bulk = [json.loads(r["value"]) for r in spark.read.text(f"{base}/bulk/*").collect() if r["value"]]
    assert sum("delete" in b for b in bulk) == 1 and sum("index" in b for b in bulk) == 4


def batch(spark, *lines):
    data = [(i, t) for i, t in enumerate(lines)]
    return spark.createDataFrame(data, "offset bigint, value string")


def test_repeated_batches_change_nothing(spark):
    base, text = config(spark)
    calls = []
    job = JobSpec.from_config(text)
    work = Ingest(spark, job, [lambda rows, n: calls.append((n, rows.count()))], ["offset"], clock=lambda: START)
    first = batch(spark, message("1"), "bad", message("2"))
    work.process(first, 0)
    before = work.ledger.totals()
    work.process(first, 0)
    assert calls == [(0, 2)] and work.ledger.totals() == before

    def fails(rows, n):
        raise OSError("down")

    broken = Ingest(spark, job, [fails], ["offset"], clock=lambda: START + timedelta(minutes=2))
    with pytest.raises(OSError):
        broken.process(batch(spark, "bad", "bad"), 1)
    again = Ingest(spark, job, [lambda rows, n: None], ["offset"], clock=lambda: START + timedelta(days=3))
    again.process(batch(spark, "bad", "bad"), 1)
    # The repeat keeps the time of the first try, so the rows are in one place only.
    assert spark.read.text(f"{base}/dirty/2024-02-01/dirty-1").count() == 2
    assert again.ledger.totals().stored_dirty == 3


def test_dirty_budget_is_exact(spark):
    base, text = config(spark)
    work = Ingest(spark, JobSpec.from_config(text), [], ["offset"], clock=lambda: START)
    for number in range(3):
        work.process(batch(spark, *["bad"] * 3), number)
    assert spark.read.text(f"{base}/dirty/*/dirty-*").count() == 5
    totals = work.ledger.totals()
    assert (totals.dirty, totals.stored_dirty) == (9, 5)


def test_limit_stops_the_job_after_the_batch(spark):
    base, text = config(spark)
    text["errorInfo"]["dirtyData"]["handleMode"] = 1
    text["sinks"] = text["sinks"][:1]
    put(spark, base, message("1", name="kept"), "bad", "bad")
    job = JobSpec.from_config(text)
    work = Ingest(spark, job, clock=lambda: START)
    with pytest.raises(Exception, match="DIRTY_COUNT_ERROR"):
        work.run(available_now=True)
    assert [r["name"] for r in stored(work, 0).collect()] == ["kept"]
    (line,) = spark.read.text(f"{base}/log/2024-01-31/error.log").collect()
    log = json.loads(line["value"])
    assert log["error_type"] == "DIRTY_COUNT_ERROR" and log["task_instance_id"] == "load-1"
    with pytest.raises(DirtyLimitExceeded):
        Ingest(spark, job, clock=lambda: START).process(batch(spark), 0)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv"])
def test_table_sink_and_upkeep(spark, fmt):
    name = f"people_{fmt}"
    tables.drop_table(spark, name)
    tables.ensure_table(spark, name, "name string, age int, country string", ["country"], fmt,
                        **({"sep": "|"} if fmt == "csv" else {}))
    base, text = config(spark)
    policy = {"rolloverEnable": True, "maxPartSize": 128, "rolloverInterval": 1, "rolloverCheckInterval": 60}
    text["sinks"] = [{"storeType": "HIVE", "storeConfig": {"database": "default", "table": name, "rollingPolicy": policy}}]
    job = JobSpec.from_config(text)
    now = [datetime.now(timezone.utc)]
    work = Ingest(spark, job, position=["offset"], clock=lambda: now[0])
    for number in range(3):
        lines = [message(f"{number}-{i}", name=f"n{i}", age=str(i), country="ab"[i % 2]) for i in range(4)]
        work.process(batch(spark, *lines), number)
        work.sinks[0](ingest_rows(batch(spark, *lines), job.schema), number)
    assert spark.table(name).count() == 0
    now[0] += timedelta(hours=1)
    work.process(batch(spark, message("z", op="DELETE", name=None, age="7", country="a")), 3)
    rows = spark.table(name)
    assert rows.count() == 13
    assert {(r["name"], r["age"], r["country"]) for r in rows.where("age = 3").collect()} == {("n3", 3, "b")}
    location = tables.describe_table(spark, name).location
    merged = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "merged-*").load(location).count()
    assert merged == 2
    assert Upkeep(spark, job, lambda: now[0]).tick() == 0
    tables.drop_table(spark, name)


def test_table_sink_taken_up_between_publishing_and_moving(spark, monkeypatch):
    tables.drop_table(spark, "broken_off")
    tables.ensure_table(spark, "broken_off", "object_key string, age bigint")
    _, text = config(spark)
    schema = JobSpec.from_config(text).schema
    write = build_sink(spark, SinkSpec("HIVE", {"table": "broken_off"}), schema)
    rows = ingest_rows(batch(spark, *[message(str(i), age=i) for i in range(9)]), schema).repartition(3)

    def fails(*_args, **_kw):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(commit, "finish", fails)
        with pytest.raises(OSError):
            write(rows, 5)
    for _ in range(2):
        write(rows.repartition(2), 5)
        assert spark.table("broken_off").agg(F.count("age"), F.sum("age")).first()[:] == (9, 36)
    tables.drop_table(spark, "broken_off")


def test_job_starts_again_after_a_failure(spark):
    base, text = config(spark)
    put(spark, base, message("1"), message("2"))
    tries = []

    def unsteady(rows, n):
        tries.append(rows.count())
        if len(tries) == 1:
            raise OSError("once")

    work = Ingest(spark, JobSpec.from_config(text), [unsteady], clock=lambda: START)
    work.run(available_now=True, pause_seconds=0)
    assert tries == [2, 2] and work.ledger.totals().consumed == 2


def test_user_sinks(spark):
    seen = []
    register_sink("mine", lambda s, spec, schema: lambda rows, n: seen.append((spec.options["x"], rows.count(), n)))
    _, text = config(spark)
    schema = JobSpec.from_config(text).schema
    build_sink(spark, SinkSpec("MINE", {"x": 1}), schema)(spark.range(3), 9)
    assert seen == [(1, 3, 9)]
    with pytest.raises(ValueError):
        build_sink(spark, SinkSpec("JANUS", {}), schema)
    assert keyed_location(spark, SinkSpec("ES", {"index": "i", "type": "t"})).endswith("/es/i/t")


def test_text_stream_windows_and_functions(spark):
    base, _ = config(spark)
    put(spark, base, "2024-01-01 00:00:01,1,a", "2024-01-01 00:00:09,2,b", "2024-01-01 00:00:10,3,c")
    parts = F.split("value", ",")
    stream = read_text_stream(spark, f"{base}/in", 1).select(
        parts[0].cast("timestamp").alias("ts"), parts[1].cast("bigint").alias("n"), parts[2].alias("v")
    )
    windows = tumbling_window(stream, "ts", "10 seconds", "v", "n", watermark="1 second")
    run = windows.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination()
    assert sorted(r["rows"] for r in spark.table("windows").collect()) == [["a", "b"], ["c"]]


def test_file_source_positions(spark):
    base, _ = config(spark)
    put(spark, base, "x", "y")
    rows = read_source(spark, SourceSpec("text", path=f"{base}/in"), streaming=False)
    assert rows.columns == ["modified", "file", "value"]
    assert [r["value"] for r in number_lines(rows).orderBy("line").collect()] == ["x", "y"]


def test_error_log(spark):
    base = scratch_path(spark, "log")
    for text in ("first", "CHECK_ERROR##no key"):
        write_error_log(spark, base, text, "7", START)
    (row,) = spark.read.text(f"{base}/2024-01-31/error.log").collect()
    assert json.loads(row["value"])["error_type"] == "CHECK_ERROR"
    assert error_record("boom", "7", START)["error_type"] == "STREAMING_ERROR"


def test_config_defaults_and_checks(spark):
    _, text = config(spark)
    kafka = {"storeType": "KAFKA", "storeConfig": {"servers": "h:1", "topic": "t", "config": {"max.poll.records": 5}}}
    job = JobSpec.from_config(json.dumps({**text, "sources": [kafka]}))
    assert job.source.options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "kafka.group.id": "millrace",
        "kafka.session.timeout.ms": "60000", "kafka.max.poll.records": "5", "startingOffsets": "earliest",
    }
    assert (job.task.parallelism, job.task.batch_ms, job.sinks[0].batch_size) == (3, 10_000, 2000)
    rolling = SinkSpec.from_config({"storeType": "hive", "storeConfig": {"database": "d", "table": "t",
                                    "rollingPolicy": {"maxPartSize": 1, "rolloverInterval": 0}}}).rolling
    assert (rolling.max_part_bytes, rolling.rollover_seconds, rolling.idle_seconds, rolling.check_seconds) == (1 << 20, 0, 60, 60)


def test_kafka_options(spark):
    def options(config=None, **more):
        section = {"storeType": "KAFKA", "storeConfig": {"servers": "h:1", "topic": "t", "config": config or {}, **more}}
        return SourceSpec.from_config(section).options

    got = options({"auto.offset.reset": "latest", "enable.auto.commit": "true", "maxOffsetsPerTrigger": 500,
                   "failOnDataLoss": "false", "security.protocol": "SSL", "key.deserializer": "x"})
    assert got["startingOffsets"] == "latest" and got["maxOffsetsPerTrigger"] == "500" and got["failOnDataLoss"] == "false"
    assert got["kafka.security.protocol"] == "SSL"
    assert not {"kafka.auto.offset.reset", "kafka.enable.auto.commit", "kafka.key.deserializer"} & set(got)
    assert json.loads(options(startingOffsets={"t": {"0": 23}})["startingOffsets"]) == {"t": {"0": 23}}
    assert "startingOffsets" not in options({"startingTimestamp": "1000"})
    with pytest.raises(SpecError):
        options({"auto.offset.reset": "none"})


def test_session_settings_of_a_job(spark):
    base, text = config(spark)
    text["taskConfig"]["config"] = {"spark.sql.files.openCostInBytes": 1234567, "state.backend": "x"}
    with pytest.warns(UserWarning, match="state.backend"):
        job = JobSpec.from_config(text)
    Ingest(spark, job, [], ["offset"])
    assert spark.conf.get("spark.sql.files.openCostInBytes") == "1234567"
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_changes_of_a_key_from_two_partitions_go_by_time(spark):
    from millrace.operators import changes
    from millrace.sources.readers import KAFKA_POSITION
    from millrace.sources.sinks import sequence_of

    data = [("t", 1, 5, 1000, "old"), ("t", 0, 90, 2000, "new")]
    rows = spark.createDataFrame(data, "topic string, partition int, offset long, timestamp long, v string").withColumn("k", F.lit(1))
    newest = changes.latest_per_key(rows.withColumn("s", sequence_of(rows, list(KAFKA_POSITION))), ["k"], "s")
    assert [r["v"] for r in newest.collect()] == ["new"]


def test_upkeep_has_a_time_for_each_table(spark):
    _, text = config(spark)
    job = JobSpec.from_config(text)

    class Fold:
        def __init__(self, seconds):
            self.upkeep_seconds, self.count = seconds, 0

        def upkeep(self):
            self.count += 1

    now, sinks = [START], [Fold(60), Fold(3600)]
    upkeep = Upkeep(spark, job, lambda: now[0], sinks)
    for _ in range(600):
        now[0] += timedelta(seconds=60)
        upkeep.tick()
    assert [s.count for s in sinks] == [600, 10]


def test_two_jobs_on_one_table_keep_all_rows(spark):
    tables.drop_table(spark, "shared_table")
    tables.ensure_table(spark, "shared_table", "object_key string, age bigint")
    for job_number in range(2):
        _, text = config(spark)
        text["sinks"] = [{"storeType": "HIVE", "storeConfig": {"database": "default", "table": "shared_table"}}]
        work = Ingest(spark, JobSpec.from_config(text), position=["offset"], clock=lambda: START)
        for number in range(3):
            work.process(batch(spark, message(f"{job_number}-{number}", age=1)), number)
        again = Ingest(spark, JobSpec.from_config(text), position=["offset"], clock=lambda: START)
        assert again.ledger.job_id() == work.ledger.job_id()
        again.sinks[0](ingest_rows(batch(spark, message("repeat", age=1)), again.job.schema), 2)
    assert spark.table("shared_table").count() == 6
    tables.drop_table(spark, "shared_table")


def test_cells_of_a_batch_by_region(spark):
    base, text = config(spark)
    options = {"url": "none", "table": "t", "path": f"{base}/wide", "cellsPath": f"{base}/cells", "logicPartitions": 100,
               "physicsPartitions": 4}
    write = build_sink(spark, SinkSpec("HBASE", options), JobSpec.from_config(text).schema)
    rows = ingest_rows(batch(spark, *[message(str(i), age=i) for i in range(40)]), JobSpec.from_config(text).schema, ["offset"])
    write(rows.withColumn("_seq", F.col("offset")), 0)
    cells = spark.read.parquet(f"{base}/cells/*")
    assert cells.count() == 80 and {r["region"] for r in cells.select("region").distinct().collect()} <= {0, 1, 2, 3}
    assert all(int(r["row_key"].split("#")[0]) < 100 for r in cells.collect())


def test_whole_windows_and_numbered_lists(spark):
    from millrace.operators.shape import collect_batch
    from millrace.streaming.windows import apply_to_windows

    rows = spark.range(5000).selectExpr("timestamp_seconds(id div 5000) AS ts", "7L AS seq", "id AS v", "id % 2 AS k")
    whole = tumbling_window(rows, "ts", "10 seconds", "v", "seq").collect()
    assert [len(r["rows"]) for r in whole] == [5000]
    parts = tumbling_window(rows, "ts", "10 seconds", "v", "seq", rows_per_list=2000).collect()
    assert sorted(len(r["rows"]) for r in parts) == [1000, 2000, 2000]
    assert sorted(len(r["rows"]) for r in collect_batch(rows, ["k"], "seq", "v", 2000).collect()) == [500, 500, 2000, 2000]
    sums = apply_to_windows(rows, "ts", "10 seconds", lambda f: f.groupby("k", as_index=False)["v"].sum(), "k long, v long")
    assert sum(r["v"] for r in sums.collect()) == 5000 * 4999 // 2


@pytest.mark.parametrize("spoil", [
    lambda c: c.pop("sinks"),
    lambda c: c.update(sinks=[]),
    lambda c: c["sinks"][0]["storeConfig"].pop("index"),
    lambda c: c["sinks"][0].update(storeType="JANUS"),
    lambda c: c["schema"].update(type="tree"),
    lambda c: c["schema"].update(type="edge"),
    lambda c: c["schema"]["operation"].pop("operateField"),
    lambda c: c["schema"].update(fields=c["schema"]["fields"][1:]),
    lambda c: c["schema"]["fields"][0].update(targetName=" "),
    lambda c: c["taskConfig"].pop("checkPoint"),
    lambda c: c["errorInfo"]["dirtyData"].update(storeType="db"),
    lambda c: c["sources"][0].update(storeType="KAFKA"),
])
def test_faulty_configs_are_refused(spark, spoil):
    _, text = config(spark)
    JobSpec.from_config(text)
    spoil(text)
    with pytest.raises(SpecError, match="CHECK_ERROR##"):
        JobSpec.from_config(text)

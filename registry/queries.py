"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions import cells, convert, dates, keys
from millrace.operators import changes, extract, layout, lookup, profile, quality, shape
from millrace.plans import compaction, grouping
from millrace.session import scratch_path
from millrace.sources import tables
from millrace.sources.keyed import KeyedTable
from millrace.spec import FieldSpec, RollingPolicy
from millrace.streaming.ingest import ingest_rows
from millrace.streaming.windows import tumbling_window

from .messages import EDGE, EDGE_MIX, VERTEX, messages, operation, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TASK, STORE, WHEN = "load-1", "HBASE,ES", "2024-02-01 00:00:00"
NOW = "1999-01-01 00:00:00"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _fields(schema):
    return [f.target for f in schema.fields]


def _day(name: str):
    return F.date_format(name, "yyyy-MM-dd").alias(name)


# Messages


@query
def extract_fields(spark, sf):
    found = extract.extract(messages(spark, sf), EDGE_MIX.fields, keep=["event_id"])
    return found.select("event_id", *_fields(EDGE_MIX))


@query
def extract_props(spark, sf):
    fields = [FieldSpec("$.k", "k", "LONG"), FieldSpec("$.none.k", "none", "STRING")]
    texts = extract.extract(table(spark, sf, "events"), fields, value="props", keep=["event_id"])
    return extract.convert_fields(texts, fields, keep=["event_id"])


@query
def convert_types(spark, sf):
    spoil = F.col("event_id") % 10
    text = F.when(spoil == 2, "abc").when(spoil == 3, "null").when(spoil == 4, "1e3").otherwise(
        F.col("value").cast("string")
    )
    flag = F.when(spoil == 0, "TRUE").when(spoil == 1, "True").otherwise(F.col("event_type"))
    texts = table(spark, sf, "events").select("event_id", text.alias("t"), flag.alias("f"))
    return texts.select(
        "event_id",
        convert.to_string(F.col("t")).alias("as_text"),
        convert.to_double(F.col("t")).alias("as_double"),
        convert.to_long(F.col("t")).alias("as_long"),
        convert.to_boolean(F.col("f")).alias("as_boolean"),
    )


@query
def convert_arrays(spark, sf):
    text = F.to_json(F.array(F.col("event_type"), F.col("user_id").cast("string")))
    parsed = table(spark, sf, "events").select("event_id", convert.to_array(text).alias("a"))
    return parsed.select("event_id", F.size("a").alias("n"), F.array_join("a", "|").alias("joined"))


@query
def normalise_numbers(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    number = rows.select(
        "l_orderkey",
        "l_linenumber",
        convert.normalise_number(F.col("l_quantity").cast("string")).alias("q"),
        convert.normalise_number(F.col("l_extendedprice").cast("string")).alias("p"),
    )
    return number.select(
        "l_orderkey",
        "l_linenumber",
        F.col("q.as_long").alias("q_long"),
        F.col("q.as_double").alias("q_double"),
        F.col("p.as_long").alias("p_long"),
        F.col("p.as_double").alias("p_double"),
    )


def _checked(spark, sf, schema, checks):
    texts = extract.extract(messages(spark, sf), schema.fields, keep=["event_id"])
    found = texts.select("event_id", quality.first_error(checks).alias("e"))
    return found.select("event_id", F.col("e.code").alias("code"), F.col("e.message").alias("message"))


@query
def check_vertex_keys(spark, sf):
    return _checked(spark, sf, VERTEX, quality.check_key())


@query
def check_edge_keys(spark, sf):
    return _checked(spark, sf, EDGE, quality.check_edge())


@query
def check_operation(spark, sf):
    return _checked(spark, sf, EDGE_MIX, quality.check_operation("_operation"))


@query
def check_required(spark, sf):
    return _checked(spark, sf, EDGE_MIX, quality.check_required(EDGE_MIX.fields))


def _validated(spark, sf, schema=EDGE_MIX, keep=("event_id",)):
    return quality.validate(messages(spark, sf), schema, keep=list(keep))


@query
def validate(spark, sf):
    good = F.col("error").isNull()
    return _validated(spark, sf).select(
        "event_id",
        F.col("error.code").alias("code"),
        *[F.when(good, F.col(f"record.{n}")).alias(n) for n in _fields(EDGE_MIX)],
    )


@query
def validate_vertices(spark, sf):
    good = F.col("error").isNull()
    return _validated(spark, sf, VERTEX).select(
        "event_id",
        F.col("error.code").alias("code"),
        *[F.when(good, F.col(f"record.{n}")).alias(n) for n in _fields(VERTEX)],
    )


def _envelopes(spark, sf):
    return quality.error_envelope(_validated(spark, sf), TASK, STORE, WHEN, keep=["event_id"])


@query
def error_envelope(spark, sf):
    return _envelopes(spark, sf)


@query
def split_counts(spark, sf):
    code = F.coalesce("error.code", F.lit("CLEAN")).alias("code")
    return _validated(spark, sf).groupBy(code).agg(F.count(F.lit(1)).alias("n"))


@query
def clean_json(spark, sf):
    return quality.clean_json(_validated(spark, sf), keep=["event_id"])


@query
def explode_batch(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return extract.explode_batch(lines, "lines", "line")


@query
def classify_op(spark, sf):
    rows = quality.clean_rows(_validated(spark, sf), keep=["event_id"])
    return changes.classify_op(rows, EDGE_MIX)


@query
def cap_dirty(spark, sf):
    capped = quality.cap_dirty(_envelopes(spark, sf), 700, ["event_id"], already_stored=200)
    return capped.select("event_id", "id", "error_type")


@query
def consumed_by_key(spark, sf):
    return quality.consumed_by(messages(spark, sf), "user_id")


@query
def dirty_by_key(spark, sf):
    return quality.dirty_by(_validated(spark, sf, keep=["event_id", "user_id"]), "user_id")


@query
def collect_batch(spark, sf):
    lists = shape.collect_batch(table(spark, sf, "events"), ["event_type"], "event_id", "user_id", 1000)
    return lists.select("event_type", "buffer", F.size("rows").alias("n"), F.array_join("rows", ",").alias("users"))


@query
def profile_types(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_totalprice",
        "o_orderpriority",
        F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("instant"),
        F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise(F.col("o_custkey").cast("string")).alias("mixed"),
    )
    return profile.profile_types(orders, orders.columns)


@query
def normalise_dates(spark, sf):
    ts, form = F.col("ts"), F.col("event_id") % 5
    text = (
        F.when(form == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(form == 1, F.date_format(ts, "yyyyMMddHHmmss"))
        .when(form == 2, F.date_format(ts, "yyyy-MM-dd"))
        .when(form == 3, F.date_format(ts, "yyyyMMdd"))
        .otherwise("no date")
    )
    rows = table(spark, sf, "events").select(
        "event_id",
        dates.parse_date(text).alias("d"),
        dates.parse_date(F.date_format(ts, dates.ISO_PATTERN)).alias("u"),
    )
    return rows.select(
        "event_id",
        dates.format_local(F.col("d")).alias("local"),
        dates.format_utc(F.col("u")).alias("utc"),
        dates.format_local(dates.shift(F.col("d"), years=-1, days=-3, hours=-5)).alias("earlier"),
        dates.format_local(dates.start_of_day(F.col("d"))).alias("day_start"),
        F.date_format(dates.end_of_day(F.col("d")), "yyyy-MM-dd HH:mm:ss.SSS").alias("day_end"),
    )


# Reads


@query
def scan_columns(spark, sf):
    return lookup.scan(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"])


@query
def scan_limit(spark, sf):
    return lookup.scan_limit(table(spark, sf, "orders"), ["o_orderkey", "o_totalprice"], 100, "o_orderkey")


@query
def point_get(spark, sf):
    wanted = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    return lookup.get_rows(table(spark, sf, "customer"), "c_custkey", wanted)


@query
def row_versions(spark, sf):
    log = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return lookup.get_versions(log, "user_id", "event_id")


# Keys and layout


@query
def row_keys(spark, sf):
    names = table(spark, sf, "customer").select(
        F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), keys.row_key(F.col("c_name")).alias("k")
    )
    texts = table(spark, sf, "conversations").select(
        F.lit("conversation").alias("source"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        keys.row_key(F.col("text")).alias("k"),
    )
    return names.unionByName(texts)


@query
def region_counts(spark, sf):
    orders = table(spark, sf, "orders").select(F.concat(F.lit("Order#"), F.col("o_orderkey")).alias("object_key"))
    placed = layout.assign_region(shape.with_row_key(orders))
    return placed.groupBy("region").agg(F.count(F.lit(1)).alias("n"))


@query
def salted_load(spark, sf):
    spread = layout.salt(messages(spark, sf), 8)
    tasks = quality.consumed_by(spread, F.spark_partition_id().alias("task"))
    return tasks.agg(F.count(F.lit(1)).alias("tasks"), F.sum("consumed").alias("consumed"))


@query
def day_buckets(spark, sf):
    bucketed = layout.day_bucket(table(spark, sf, "events"), "ts")
    return bucketed.groupBy("dt", "event_type").agg(F.count(F.lit(1)).alias("n"))


# Shapes


def _vertices(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("object_key"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("bigint").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )


def _edges(spark, sf):
    return table(spark, sf, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey")).alias("object_key"),
        F.col("o_custkey").cast("string").alias("from_key"),
        F.col("o_orderkey").cast("string").alias("to_key"),
        F.col("o_totalprice").alias("price"),
    )


@query
def document_shape(spark, sf):
    known = F.when(F.col("nation") == 0, F.col("name"))
    return shape.to_document(_vertices(spark, sf).withColumn("id", known))


@query
def graph_vertices(spark, sf):
    return shape.to_graph(_vertices(spark, sf), "vertex")


@query
def graph_edges(spark, sf):
    return shape.to_graph(_edges(spark, sf), "edge")


@query
def cells_roundtrip(spark, sf):
    types = {"object_key": "STRING", "name": "STRING", "nation": "LONG", "balance": "DOUBLE"}
    found = shape.rows_to_cells(shape.with_row_key(_vertices(spark, sf)), types)
    return shape.cells_to_rows(found, types).drop("row_key")


@query
def cell_bytes(spark, sf):
    """Cells with their bytes in hex."""
    types = {"object_key": "STRING", "name": "STRING", "nation": "LONG"}
    found = shape.rows_to_cells(_vertices(spark, sf).withColumn("_row_key", F.col("object_key")), types)
    return found.select("row_key", "family", "qualifier", F.hex("value").alias("bytes"))


@query
def array_cells(spark, sf):
    texts = F.transform(F.col("embedding"), lambda x: x.cast("string"))
    stored = table(spark, sf, "embeddings").select("vec_id", cells.encode(texts, "ARRAY").alias("b"))
    values = F.transform(cells.decode(F.col("b"), "ARRAY"), lambda t: F.round(t.cast("double") * 1_000_000).cast("bigint"))
    return stored.select("vec_id", F.array_join(values, ",").alias("millionths"))


@query
def bulk_lines(spark, sf):
    rows = _vertices(spark, sf)
    columns = ["object_key", "name", "nation", "balance"]
    return shape.bulk_lines(rows, "people", "person", F.col("balance") < 0, columns=columns)


@query
def bulk_batch_sizes(spark, sf):
    rows = _edges(spark, sf).select("object_key")
    salt = F.pmod(keys.string_hash(F.col("object_key")), F.lit(8))
    batches = shape.bulk_batches(rows, ["object_key"], 2000, salt=salt)
    return batches.groupBy("salt", "batch").agg(F.count(F.lit(1)).alias("n"))


@query
def bulk_payloads(spark, sf):
    """The texts of all bulk requests."""
    columns = ["object_key", "name", "nation", "balance"]
    lines = shape.bulk_lines(_vertices(spark, sf), "people", "person", columns=columns)
    salt = F.pmod(keys.string_hash(F.col("object_key")), F.lit(8))
    return shape.bulk_payload(shape.bulk_batches(lines, ["object_key"], 100, salt=salt), ["object_key"])


@query
def text_lines(spark, sf):
    rows = table(spark, sf, "orders").withColumn(
        "priority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    )
    return shape.text_lines(
        rows.select("o_orderkey", "o_custkey", "priority", "o_orderstatus"), ["o_orderkey", "o_custkey", "priority"]
    )


@query
def conform_types(spark, sf):
    columns = [
        ("o_orderkey", "string"),
        ("o_custkey", "smallint"),
        ("o_totalprice", "bigint"),
        ("o_orderstatus", "boolean"),
        ("o_orderpriority", "double"),
        ("o_clerk", "string"),
    ]
    return tables.conform(table(spark, sf, "orders"), columns)


# Changes


def _target(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def _log(spark, sf, key):
    return table(spark, sf, "events").select(
        key.alias("c_custkey"),
        "event_id",
        F.concat(F.lit("event"), F.col("event_id")).alias("c_name"),
        F.col("value").alias("c_acctbal"),
        F.col("event_type").alias("c_mktsegment"),
        operation(F.col("event_type")).alias("op"),
    )


def _is_delete():
    return F.col("op") == "DELETE"


@query
def upsert_replace(spark, sf):
    log = _log(spark, sf, F.col("user_id"))
    return changes.upsert_replace(_target(spark, sf), log, ["c_custkey"], "event_id")


@query
def upsert_patch(spark, sf):
    log = _log(spark, sf, keys.run_of(F.col("event_id"), 4)).withColumns(
        {
            "c_acctbal": F.when(F.col("op") == "UPDATE", F.col("c_acctbal")),
            "c_mktsegment": F.when(F.col("op") == "UPSERT", F.col("c_mktsegment")),
            "c_name": F.when(F.col("op") == "ADD", F.col("c_name")),
        }
    )
    return changes.upsert_patch(_target(spark, sf), log, ["c_custkey"], "event_id", _is_delete())


@query
def delete_by_key(spark, sf):
    deletes = table(spark, sf, "events").where("event_type = 'error'")
    return changes.delete_by_key(
        _target(spark, sf), deletes.select(F.col("user_id").alias("c_custkey")), ["c_custkey"]
    )


@query
def apply_sequence(spark, sf):
    log = _log(spark, sf, keys.run_of(F.col("event_id"), 2))
    return changes.apply_batch(_target(spark, sf), log, ["c_custkey"], "event_id", _is_delete())


@query
def apply_delete_first(spark, sf):
    log = _log(spark, sf, keys.run_of(F.col("event_id"), 2))
    return changes.apply_batch(
        _target(spark, sf), log, ["c_custkey"], "event_id", _is_delete(), order="delete_first"
    )


@query
def keyed_table(spark, sf):
    """The change log applied to a stored table in three batches, the middle one twice, with one fold
    between them."""
    start = _target(spark, sf)
    stored = KeyedTable(spark, scratch_path(spark, "keyed"), start.schema, ["c_custkey"], buckets=8)
    stored.apply(start.withColumn("event_id", F.lit(0)), "event_id", 0)
    log = _log(spark, sf, keys.run_of(F.col("event_id"), 2))
    third = log.count() // 3
    bounds = [(None, third), (third, 2 * third), (third, 2 * third), (2 * third, None)]
    for number, (low, high) in zip((1, 2, 2, 3), bounds):
        part = log
        if low is not None:
            part = part.where(F.col("event_id") >= low)
        if high is not None:
            part = part.where(F.col("event_id") < high)
        stored.apply(part, "event_id", number, _is_delete())
        if number == 1:
            stored.fold()
    return stored.read()


@query
def ingest(spark, sf):
    """Messages to the table they keep: checked, converted, and applied by key."""
    rows = ingest_rows(messages(spark, sf), EDGE_MIX, keep=["event_id"])
    flagged = changes.classify_op(rows, EDGE_MIX)
    # Elements of the graph are named by the user here, so that keys repeat.
    keyed = flagged.withColumn("object_key", F.col("from_key"))
    empty = keyed.drop("event_id", changes.DELETE_FLAG).limit(0)
    return changes.apply_batch(empty, keyed, ["object_key"], "event_id", F.col(changes.DELETE_FLAG))


# Files


@query
def missing_partitions(spark, sf):
    rows = table(spark, sf, "lineitem")
    registered = rows.where("l_linestatus = 'O'").select("l_returnflag", "l_linestatus").distinct()
    return lookup.missing_partitions(rows, registered, ["l_returnflag", "l_linestatus"])


@query
def partition_readback(spark, sf):
    path = scratch_path(spark, "partitioned")
    layout.write_partitioned(table(spark, sf, "lineitem"), path, ["l_returnflag", "l_linestatus"])
    return spark.read.parquet(path).withColumn("l_shipdate", _day("l_shipdate"))


@query
def partition_by_expr(spark, sf):
    path = scratch_path(spark, "by-expr")
    kind = F.concat(F.upper(F.substring("event_type", 1, 1)), F.lit("/"), F.col("user_id") % 3)
    rows = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    layout.write_partitioned(rows, path, [("kind", kind)], fmt="orc")
    return spark.read.orc(path)


@query
def compacted_rows(spark, sf):
    path = scratch_path(spark, "compacted")
    rows = table(spark, sf, "lineitem").repartition(12)
    rows.write.partitionBy("l_returnflag").parquet(path)
    compaction.compact(spark, path, policy=RollingPolicy(enabled=True, max_part_bytes=200_000, rollover_seconds=0))
    return compaction.read_table(spark, path).withColumn("l_shipdate", _day("l_shipdate"))


def _as_files(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("dir"),
        F.col("o_orderkey").alias("path"),
        F.col("o_orderdate").alias("mtime"),
        F.round("o_totalprice").cast("bigint").alias("length"),
    )


@query
def plan_by_size(spark, sf):
    planned = grouping.plan_by_size(_as_files(spark, sf), 5_000_000, order=["path"], rows_per_block=4000)
    return planned.select("dir", "path", "group_no")


@query
def plan_by_age(spark, sf):
    now = F.lit(NOW).cast("timestamp_ntz")
    old = grouping.plan_by_age(_as_files(spark, sf), now, 400 * 86400, 300 * 86400)
    return old.select("dir", "path")


@query
def chunk_files(spark, sf):
    chunks = grouping.chunk_files(_as_files(spark, sf), 1024, order=["mtime", "path"], rows_per_block=4000)
    return chunks.select("dir", "path", "chunk_no")


def _windows(spark, sf, rows_per_list=None):
    lists = tumbling_window(
        table(spark, sf, "events"), "ts", "10 seconds", "user_id", "event_id", ["event_type"], rows_per_list
    )
    return lists.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("start"),
        F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("stop"),
        "event_type",
        "part",
        F.array_join("rows", ",").alias("users"),
    )


@query
def tumbling_batches(spark, sf):
    return _windows(spark, sf)


@query
def tumbling_lists(spark, sf):
    """The same with at most two values a list."""
    return _windows(spark, sf, 2)


@query
def window_function(spark, sf):
    """A function of the user's own on whole windows."""
    from millrace.streaming.windows import apply_to_windows

    def summed(rows):
        return rows.groupby(["window_start", "event_type"], as_index=False).agg(n=("event_id", "count"), last=("event_id", "max"))

    events = table(spark, sf, "events").select("ts", "event_type", "event_id")
    found = apply_to_windows(events, "ts", "1 day", summed, "window_start timestamp, event_type string, n long, last long", ["event_type"])
    return found.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))

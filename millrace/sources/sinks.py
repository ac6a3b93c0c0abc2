"""What happens to good rows: sinks by store type, and the files of bad rows and errors.

A sink is `callable(rows, batch_id)`; a repeated batch leaves it as it was. `rows` has
the declared fields, the source's position columns and `_seq`, which orders changes.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.convert import SPARK_TYPES
from ..functions.keys import LOGIC_PARTITIONS
from ..operators import changes
from ..operators.layout import assign_region, single_writer, spread_for_write
from ..operators.shape import (
    ROW_KEY, bulk_batches, bulk_lines, bulk_payload, rows_to_cells, text_lines, to_document, to_graph, with_row_key,
)
from ..plans.compaction import commit_staged, forget_commits, is_committed
from ..spec import MESSAGE_BREAK, OBJECT_KEY, STREAMING_ERROR, SchemaSpec, SinkSpec
from .bucketed import BucketedTable
from .keyed import KeyedTable
from .tables import conform, describe_table

SEQ = "_seq"

Sink = Callable[[DataFrame, int], None]
SinkFactory = Callable[[SparkSession, SinkSpec, SchemaSpec], Sink]
_factories: dict[str, SinkFactory] = {}


def register_sink(store_type: str, factory: SinkFactory) -> None:
    """Make or replace the sink of a store type."""
    _factories[store_type.upper()] = factory


def build_sink(spark: SparkSession, spec: SinkSpec, schema: SchemaSpec) -> Sink:
    if spec.store_type not in _factories:
        raise ValueError(f"no sink for store type [{spec.store_type}]")
    return _factories[spec.store_type](spark, spec, schema)


def batch_tag(batch_id: int, job_id: str = "") -> str:
    """Names a batch of a job; batch numbers count within a job only."""
    return f"{job_id}-batch{batch_id:012d}" if job_id else f"batch{batch_id:012d}"


def record_type(schema: SchemaSpec) -> T.StructType:
    """Columns of a good row once the operation column is gone."""
    fields = [f for f in schema.fields if not (schema.is_mix and f.target == schema.op_field)]
    return T.StructType([T.StructField(f.target, SPARK_TYPES.get(f.type, T.StringType())) for f in fields])


def write_text(df: DataFrame, path: str, columns: list[str], delimiter: str, partition_columns: list[str]) -> None:
    lines = text_lines(df.select(*columns, *partition_columns), columns, delimiter)
    writer = spread_for_write(lines, partition_columns).write.mode("overwrite")
    (writer.partitionBy(*partition_columns) if partition_columns else writer).text(path)


def stage_rows(df: DataFrame, path: str, fmt: str, partition_columns: list[str]) -> None:
    writer = spread_for_write(df, partition_columns).write.format(fmt).mode("overwrite")
    (writer.partitionBy(*partition_columns) if partition_columns else writer).save(path)


def table_sink(spark: SparkSession, spec: SinkSpec, schema: SchemaSpec) -> Sink:
    """Rows appended to a catalog table, partitioned as it is; operations play no part."""
    name = f"{spec.options.get('database') or 'default'}.{spec.options['table']}"
    info = describe_table(spark, name)
    parts = list(info.partition_columns)

    def write(rows: DataFrame, batch_id: int) -> None:
        tag = batch_tag(batch_id, spec.job_id)
        stage = f"{info.location}/_stage/{tag}"
        if not is_committed(spark, info.location, tag):
            fitted = conform(rows, info.columns)
            if info.format == "text":
                write_text(fitted, stage, [c for c, _ in info.data_columns], info.delimiter, parts)
            else:
                stage_rows(fitted, stage, info.format, parts)
        commit_staged(spark, stage, info.location, tag, info.format)
        forget_commits(spark, info.location)
        spark.catalog.refreshTable(name)

    return write


def keyed_location(spark: SparkSession, spec: SinkSpec) -> str:
    o = spec.options
    if o.get("path"):
        return o["path"]
    parts = [
        o.get(k) for k in ("namespace", "database", "index", "collection", "table", "type") if o.get(k)
    ]
    return "/".join([spark.conf.get("spark.sql.warehouse.dir").rstrip("/"), spec.store_type.lower(), *parts])


class KeyedSink:
    """Rows applied to a keyed table; its changes are folded into the base on an interval."""

    def __init__(self, table: KeyedTable | BucketedTable, spec: SinkSpec, schema: SchemaSpec, shape):
        self.table, self.spec, self.schema, self.shape = table, spec, schema, shape
        self.order = spec.options.get("order", "sequence")
        self.upkeep_seconds = spec.fold_seconds

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        shaped = self.shape(changes.classify_op(rows, self.schema), self.schema)
        delete = F.col(changes.DELETE_FLAG)
        self.table.apply(shaped, SEQ, batch_id, delete, self.order, self.spec.job_id)

    def upkeep(self) -> None:
        self.table.fold()
        self.table.vacuum(float(self.spec.options.get("keepSeconds") or 3600))


def _keyed_sink(shape, extra: list[str], key: str, patch: bool) -> Callable[..., KeyedSink]:
    """Sinks whose batches replace whole rows or overwrite only the fields they carry."""

    def factory(spark: SparkSession, spec: SinkSpec, schema: SchemaSpec) -> KeyedSink:
        columns = record_type(schema)
        for name in extra if schema.is_edge else [n for n in extra if n not in ("_from", "_to")]:
            if name not in columns.names:
                columns = columns.add(name, T.StringType())
        buckets = int(spec.options.get("buckets", 64))
        name = spec.options.get("bucketedTable")
        if name:
            table = BucketedTable(spark, name, columns, [key], int(spec.options.get("tablePartitions", 64)), buckets, patch)
        else:
            table = KeyedTable(spark, keyed_location(spark, spec), columns, [key], buckets, patch)
        return KeyedSink(table, spec, schema, shape)

    return factory


def _bulk_requests(rows: DataFrame, spec: SinkSpec, schema: SchemaSpec) -> DataFrame:
    flagged = to_document(changes.classify_op(rows, schema))
    columns = record_type(schema).names + (["id"] if "id" not in record_type(schema).names else [])
    newest = changes.latest_per_key(flagged, [OBJECT_KEY], SEQ)
    lines = bulk_lines(
        newest, spec.options["index"], spec.options["type"], F.col(changes.DELETE_FLAG), columns=columns
    )
    return bulk_payload(bulk_batches(lines, [OBJECT_KEY], spec.batch_size), [OBJECT_KEY])


class _WithExtra:
    """A keyed sink that also writes each batch in a store's own shape."""

    def __init__(self, keyed: KeyedSink, also: Sink):
        self.keyed, self.also = keyed, also
        self.upkeep_seconds, self.upkeep = keyed.upkeep_seconds, keyed.upkeep

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        self.keyed(rows, batch_id)
        self.also(rows, batch_id)


def document_sink(spark: SparkSession, spec: SinkSpec, schema: SchemaSpec) -> Sink:
    """Documents replaced by id; with a `payloadPath`, also the bulk requests as text."""
    keyed = _keyed_sink(lambda df, _: to_document(df), ["id"], OBJECT_KEY, patch=False)(spark, spec, schema)
    payload_path = spec.options.get("payloadPath")
    if not payload_path:
        return keyed

    def requests(rows: DataFrame, batch_id: int) -> None:
        texts = _bulk_requests(rows, spec, schema).select("payload")
        texts.write.mode("overwrite").option("lineSep", "\n").text(f"{payload_path}/{batch_tag(batch_id, spec.job_id)}")

    return _WithExtra(keyed, requests)


def wide_column_sink(spark: SparkSession, spec: SinkSpec, schema: SchemaSpec) -> Sink:
    """Rows patched by row key; with a `cellsPath`, also the batch's cells in row key order, a range of
    regions to a file. `logicPartitions` and `physicsPartitions` lay out keys and regions."""
    n_logic = int(spec.options.get("logicPartitions") or LOGIC_PARTITIONS)
    n_physical = int(spec.options.get("physicsPartitions") or 16)
    keyed = _keyed_sink(lambda df, _: with_row_key(df, n_logic=n_logic), [ROW_KEY], ROW_KEY, patch=True)(spark, spec, schema)
    cells_path = spec.options.get("cellsPath")
    if not cells_path:
        return keyed
    types = {f.target: f.type for f in schema.fields if not (schema.is_mix and f.target == schema.op_field)}

    def cells(rows: DataFrame, batch_id: int) -> None:
        flagged = with_row_key(changes.classify_op(rows, schema), n_logic=n_logic)
        newest = changes.latest_per_key(flagged, [ROW_KEY], SEQ).where(~F.col(changes.DELETE_FLAG))
        placed = assign_region(rows_to_cells(newest, types), n_logic, n_physical, "row_key")
        ordered = placed.repartitionByRange(n_physical, "region", "row_key").sortWithinPartitions("row_key", "qualifier")
        ordered.write.mode("overwrite").parquet(f"{cells_path}/{batch_tag(batch_id, spec.job_id)}")

    return _WithExtra(keyed, cells)


register_sink("HIVE", table_sink)
register_sink("ES", document_sink)
register_sink("HBASE", wide_column_sink)
register_sink("GDB", _keyed_sink(lambda df, s: to_graph(df, s.kind), ["_key", "_from", "_to"], "_key", patch=True))
register_sink("ATLAS", _factories["GDB"])


def sink_dirty(envelopes: DataFrame, path: str, day: str, batch_id: int) -> None:
    """Error rows as JSON lines in a directory per day; a repeated batch writes the same
    place. The rows are capped before, so one file holds them."""
    target = f"{path.rstrip('/')}/{day}/dirty-{batch_id}"
    single_writer(envelopes).write.mode("overwrite").text(target)


def error_record(message: str, task_instance_id: str, now: datetime) -> dict[str, str]:
    """The error row of a failed job; a message may carry its own code before a break."""
    code, found, rest = message.partition(MESSAGE_BREAK)
    return {
        "id": str(int(now.timestamp() * 1000)),
        "object_key": "",
        "task_instance_id": task_instance_id,
        "error_type": code if found else STREAMING_ERROR,
        "error_log": rest if found else message,
        "affected_store": "",
        "data_row": "",
        "updated_dt": now.strftime("%Y-%m-%d %H:%M:%S"),
    }


def write_error_log(spark: SparkSession, path: str, message: str, task_instance_id: str, now: datetime) -> None:
    """The failure of a job as one JSON text, replacing an earlier one of the day."""
    text = json.dumps(error_record(message, task_instance_id, now), ensure_ascii=False)
    row = spark.createDataFrame([(text,)], "value string")
    single_writer(row).write.mode("overwrite").text(f"{path.rstrip('/')}/{now:%Y-%m-%d}/error.log")


def sequence_of(df: DataFrame, columns: list[str]) -> Column:
    """A change order from the source's position columns."""
    return F.struct(*columns) if len(columns) > 1 else F.col(columns[0])

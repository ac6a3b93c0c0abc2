"""Rows of a stream appended to files by Spark's own sink, and windows that close.

The sink keeps a log of the files of every batch beside them. A batch that is run again after a stop is
found in the log and leaves nothing twice; a reader of the folder goes by the log, so files of a broken
off batch are not seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import quality
from ..spec import SchemaSpec
from .windows import tumbling_window


def append_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    available_now: bool = False,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Start appending a stream to files below `path`; one stream to a folder."""
    writer = stream.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def appended(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """What a stream has appended, each row once. With a schema also before the first row is there."""
    reader = spark.read.format(fmt)
    return (reader if schema is None else reader.schema(schema)).load(path)


def checked_rows(messages: DataFrame, schema: SchemaSpec, keep: Sequence[str] = ()) -> DataFrame:
    """The good rows of a stream of messages, as expressions only, so that any of Spark's sinks can take them."""
    return quality.clean_rows(quality.validate(messages, schema, keep=keep), keep=keep)


def closed_windows(
    stream: DataFrame, ts: str, length: str, value: str, seq: str, keys: Sequence[str], watermark: str
) -> DataFrame:
    """Windows of a stream, each given once, when the watermark has passed its end, and then dropped from the
    state. Rows that come later than that are left out; the query's progress counts them. For append mode."""
    return tumbling_window(stream, ts, length, value, seq, keys, watermark=watermark)

"""Messages as frames: Kafka topics, text lines, or any file format Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..spec import SourceSpec

# By time first: changes of one key may come from several partitions.
KAFKA_POSITION = ("timestamp", "topic", "partition", "offset")
FILE_POSITION = ("modified", "file", "line")


def position_columns(source: SourceSpec) -> tuple[str, ...]:
    """Columns that name and order the messages of a source."""
    return KAFKA_POSITION if source.format == "kafka" else FILE_POSITION


def read_source(
    spark: SparkSession, source: SourceSpec, streaming: bool = True, schema: T.StructType | None = None
) -> DataFrame:
    """Messages in the column `value`, and where each one stands in the source: time, topic,
    partition and offset in Kafka, modification time and file elsewhere."""
    reader = (spark.readStream if streaming else spark.read).format(source.format)
    reader = reader.options(**source.options)
    if schema is not None:
        reader = reader.schema(schema)
    if source.format == "kafka":
        rows = reader.load()
        return rows.select(*KAFKA_POSITION, F.col("value").cast("string").alias("value"))
    rows = reader.load(source.path)
    meta = F.col("_metadata")
    return rows.select(
        meta.getField("file_modification_time").alias("modified"),
        meta.getField("file_path").alias("file"),
        *rows.columns,
    )


def number_lines(batch: DataFrame) -> DataFrame:
    """Adds `line`, which rises with the place in the file; for batches, not for streams."""
    return batch.withColumn("line", F.monotonically_increasing_id())


def read_text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in a directory."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)

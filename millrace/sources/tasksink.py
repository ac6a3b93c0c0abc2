"""Sinks of the user's own that write from tasks, as a data source of Spark.

Every task opens a store and hands it its Arrow batches; what the task wrote becomes visible when the
driver commits the messages of all tasks, by batch, and is taken back where a task failed. It works for
tables and streams: `df.write.format(name)` and `stream.writeStream.format(name)`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..session import ship_package


class Store(Protocol):
    """What a user's sink does. `write` runs in tasks, the others on the driver."""

    def write(self, batches: Iterator[pa.RecordBatch], task: str) -> Any:
        """Write a task's rows under a name no other attempt has; what is returned goes to `commit`."""

    def commit(self, batch: str, results: list[Any]) -> None:
        """Make a batch visible; a batch that comes again replaces what it was."""

    def abort(self, results: list[Any]) -> None:
        """Take back what tasks wrote of a batch that failed."""


@dataclass
class _Done(WriterCommitMessage):
    result: Any


class _Write:
    def __init__(self, store: Store, batch: str | None):
        self.store, self.batch = store, batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Done:
        context = TaskContext.get()
        place = f"{context.partitionId()}-{context.taskAttemptId()}" if context else "0"
        return _Done(self.store.write(iterator, f"{place}-{uuid.uuid4().hex}"))

    def _results(self, messages: list) -> list[Any]:
        return [m.result for m in messages if m is not None]


class _TableWriter(_Write, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self.store.commit(self.batch or uuid.uuid4().hex, self._results(messages))

    def abort(self, messages: list) -> None:
        self.store.abort(self._results(messages))


class _StreamWriter(_Write, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self.store.commit(str(batchId), self._results(messages))

    def abort(self, messages: list, batchId: int) -> None:
        self.store.abort(self._results(messages))


def register_task_sink(spark: SparkSession, name: str, make: Callable[[dict], Store]) -> None:
    """Make `name` a format whose rows go to the stores that `make(options)` gives, on every task and on
    the driver. The option `batch` names a table's write, so that it can be repeated."""
    ship_package(spark)

    class TaskSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
            return _TableWriter(make(dict(self.options)), self.options.get("batch"))

        def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
            return _StreamWriter(make(dict(self.options)), None)

    spark.dataSource.register(TaskSink)


class FileStore:
    """A store of Parquet files: a batch is a list of files, written last, so readers see it whole or not at
    all. Any file system that pyarrow opens by its address."""

    def __init__(self, options: dict):
        self.address = options["path"].rstrip("/")

    def _fs(self) -> tuple[pyarrow.fs.FileSystem, str]:
        return pyarrow.fs.FileSystem.from_uri(self.address)

    def write(self, batches: Iterator[pa.RecordBatch], task: str) -> str | None:
        fs, root = self._fs()
        writer, path = None, f"{root}/data/{task}.parquet"
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if writer is None:
                    fs.create_dir(f"{root}/data", recursive=True)
                    writer = pq.ParquetWriter(path, batch.schema, filesystem=fs)
                writer.write_batch(batch)
        except BaseException:
            if writer is not None:
                writer.close()
                fs.delete_file(path)
            raise
        if writer is not None:
            writer.close()
        return f"{task}.parquet" if writer is not None else None

    def commit(self, batch: str, results: list[str | None]) -> None:
        fs, root = self._fs()
        fs.create_dir(f"{root}/batches", recursive=True)
        fresh = f"{root}/.{batch}-{uuid.uuid4().hex}"
        with fs.open_output_stream(fresh) as out:
            out.write(json.dumps(sorted(r for r in results if r)).encode())
        fs.move(fresh, f"{root}/batches/{batch}")

    def abort(self, results: list[str | None]) -> None:
        fs, root = self._fs()
        for name in results:
            if name:
                fs.delete_file(f"{root}/data/{name}")

    def files(self) -> list[str]:
        """The files of all batches."""
        fs, root = self._fs()
        found = fs.get_file_info(pyarrow.fs.FileSelector(f"{root}/batches", allow_not_found=True))
        names: list[str] = []
        for info in found:
            with fs.open_input_stream(info.path) as lines:
                names += json.loads(lines.read())
        return [f"{self.address}/data/{n}" for n in names]

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """The rows of all batches."""
        files = self.files()
        return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)

"""The loading job: messages to checked rows, to every sink, batch by batch."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality
from ..plans.compaction import compact
from ..sources.readers import number_lines, position_columns, read_source
from ..sources.sinks import SEQ, Sink, build_sink, sequence_of, sink_dirty, write_error_log
from ..sources.tables import add_partitions, describe_table, refresh_partitions
from ..spec import JobSpec, RollingPolicy, SchemaSpec
from .ledger import Ledger


def _now() -> datetime:
    return datetime.now(timezone.utc)


class Upkeep:
    """What sinks need now and then, each no more often than its own interval, when data arrives:
    tables of the catalog get their files merged and partitions registered, keyed tables fold their
    changes."""

    def __init__(
        self, spark: SparkSession, job: JobSpec, clock: Callable[[], datetime] = _now, sinks: Sequence[Sink] = ()
    ):
        self.spark, self.clock = spark, clock
        self.work: list[tuple[int, Callable[[], None]]] = []
        for s in job.sinks:
            if s.store_type == "HIVE":
                name = f"{s.options.get('database') or 'default'}.{s.options['table']}"
                self.work.append((s.rolling.check_seconds, partial(self._table, name, s.rolling)))
                if s.refresh_seconds:
                    self.work.append((s.refresh_seconds, partial(refresh_partitions, spark, name)))
        self.work += [(s.upkeep_seconds, s.upkeep) for s in sinks if hasattr(s, "upkeep")]
        self.last = [clock()] * len(self.work)

    def _table(self, name: str, rolling: RollingPolicy) -> None:
        info = describe_table(self.spark, name)
        if rolling.enabled:
            schema = self.spark.table(name).schema
            compact(self.spark, info.location, info.format, rolling, now=self.clock(), schema=schema)
        if info.partition_columns:
            add_partitions(self.spark, name)
        self.spark.catalog.refreshTable(name)

    def tick(self) -> int:
        """The number of things done."""
        now, done = self.clock(), 0
        for i, (seconds, work) in enumerate(self.work):
            if (now - self.last[i]).total_seconds() >= seconds:
                work()
                self.last[i] = now
                done += 1
        return done


class Ingest:
    """One loading job. `process` takes a batch; `start` runs it on a stream."""

    def __init__(
        self,
        spark: SparkSession,
        job: JobSpec,
        sinks: Sequence[Sink] | None = None,
        position: Sequence[str] | None = None,
        clock: Callable[[], datetime] = _now,
    ):
        self.spark, self.job, self.clock = spark, job, clock
        self.position = list(position or position_columns(job.source))
        self.ledger = Ledger(spark, f"{job.task.checkpoint.rstrip('/')}/totals")
        if sinks is None:
            # Batch numbers count within a checkpoint, so its name goes with them.
            ident = self.ledger.job_id()
            sinks = [build_sink(spark, replace(s, job_id=ident), job.schema) for s in job.sinks]
        self.sinks = list(sinks)
        self.upkeep = Upkeep(spark, job, clock, self.sinks)
        self.progress: dict[str, int] = {}
        for name, value in job.task.settings.items():
            spark.conf.set(name, value)

    def validated(self, messages: DataFrame) -> DataFrame:
        return quality.validate(messages, self.job.schema, keep=self.position)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Apply one batch; a batch that is done already changes nothing."""
        before = self.ledger.totals()
        dirty_spec = self.job.dirty
        if batch_id <= before.batch_id:
            quality.fail_over(before.dirty, dirty_spec.handle_mode)
            return
        started = self.ledger.start(batch_id, self.clock())
        if "line" in self.position and "line" not in batch.columns:
            batch = number_lines(batch)
        checked = self.validated(batch).persist()
        try:
            counted = checked.agg(
                F.count(F.lit(1)).alias("n"), F.count_if(F.col("error").isNotNull()).alias("bad")
            ).first()
            self.progress = {"batch": batch_id, "consumed": before.consumed + counted["n"], "dirty": before.dirty + counted["bad"]}
            stored = 0
            if dirty_spec.enabled and counted["bad"]:
                stored = min(counted["bad"], max(0, dirty_spec.rows_limit - before.stored_dirty))
                self._store_dirty(checked, before.stored_dirty, started, batch_id)
            rows = quality.clean_rows(checked, keep=self.position)
            rows = rows.withColumn(SEQ, sequence_of(rows, self.position))
            for sink in self.sinks:
                sink(rows, batch_id)
        finally:
            checked.unpersist()
        totals = before.plus(batch_id, counted["n"], counted["bad"], stored, started.isoformat())
        self.ledger.finish(totals)
        quality.fail_over(totals.dirty, dirty_spec.handle_mode)
        self.upkeep.tick()

    def _store_dirty(self, checked: DataFrame, already: int, started: datetime, batch_id: int) -> None:
        spec = self.job.dirty
        envelopes = quality.error_envelope(
            checked,
            spec.task_instance_id,
            self.job.affected_store,
            started.strftime("%Y-%m-%d %H:%M:%S"),
            keep=self.position,
        )
        capped = quality.cap_dirty(envelopes, spec.rows_limit, self.position, already)
        sink_dirty(quality.envelope_json(capped), spec.path, started.strftime("%Y-%m-%d"), batch_id)

    def start(self, messages: DataFrame | None = None, available_now: bool = False) -> StreamingQuery:
        """Run on the job's source, or on a given stream with the position columns."""
        if messages is None:
            messages = read_source(self.spark, self.job.source)
        trigger = {"availableNow": True} if available_now else {"processingTime": f"{self.job.task.batch_ms} milliseconds"}
        return (
            messages.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.job.task.checkpoint.rstrip('/')}/stream")
            .trigger(**trigger)
            .start()
        )

    def run(
        self, messages: DataFrame | None = None, available_now: bool = False, pause_seconds: float = 10
    ) -> None:
        """Run to the end, starting again after a failure and a pause as often as the job
        allows. The last failure is written to the error log."""
        for attempt in range(self.job.task.restarts + 1):
            try:
                self.start(messages, available_now).awaitTermination()
                return
            except Exception as failure:
                over = "DIRTY_COUNT_ERROR" in str(failure)
                if over or attempt == self.job.task.restarts:
                    self._log(failure)
                    raise
                time.sleep(pause_seconds)

    def _log(self, failure: Exception) -> None:
        if not self.job.log_path:
            return
        text = str(failure)
        at = text.find("DIRTY_COUNT_ERROR##")
        message = text[at:].splitlines()[0] if at >= 0 else text
        write_error_log(self.spark, self.job.log_path, message, self.job.dirty.task_instance_id, self.clock())


def ingest_rows(messages: DataFrame, schema: SchemaSpec, keep: Sequence[str] = ()) -> DataFrame:
    """The good rows of a table of messages, as a job would hand them to its sinks."""
    return quality.clean_rows(quality.validate(messages, schema, keep=keep), keep=keep)

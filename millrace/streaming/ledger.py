"""Totals of a stream, kept outside the engine's checkpoint so that they stay exact.

One small record per batch, each with the totals so far, so that only the last is read.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass, replace
from datetime import datetime

from pyspark.sql import SparkSession

from ..sources.fs import Files

_SCHEMA = "batch_id long, consumed long, dirty long, stored_dirty long, started string"


@dataclass(frozen=True)
class Totals:
    batch_id: int = -1
    consumed: int = 0
    dirty: int = 0
    stored_dirty: int = 0
    started: str = ""

    def plus(self, batch_id: int, consumed: int, dirty: int, stored: int, started: str) -> "Totals":
        return replace(
            self,
            batch_id=batch_id,
            consumed=self.consumed + consumed,
            dirty=self.dirty + dirty,
            stored_dirty=self.stored_dirty + stored,
            started=started,
        )


class Ledger:
    def __init__(self, spark: SparkSession, path: str, keep: int = 20):
        self.spark, self.keep = spark, keep
        self.files = Files(spark, path)
        self.path = path.rstrip("/")

    def job_id(self) -> str:
        """A name for the checkpoint that this ledger lies in: the same for every run on it, another
        for every other checkpoint. Made at the first call; of two made at once the first in order counts."""
        folder = f"{self.path}/job"
        found = [n for n in self.files.names(folder)]
        if not found:
            self.files.mkdirs(f"{folder}/{uuid.uuid4().hex}")
            found = self.files.names(folder)
        return found[0]

    def _numbers(self, kind: str) -> list[int]:
        names = self.files.names(f"{self.path}/{kind}")
        return sorted(int(n) for n in names if self.files.exists(f"{self.path}/{kind}/{n}/_SUCCESS"))

    def _write(self, kind: str, totals: Totals) -> None:
        row = self.spark.createDataFrame([tuple(asdict(totals).values())], _SCHEMA).coalesce(1)
        row.write.mode("overwrite").json(f"{self.path}/{kind}/{totals.batch_id}")

    def _read(self, kind: str, number: int) -> Totals:
        row = self.spark.read.schema(_SCHEMA).json(f"{self.path}/{kind}/{number}").first()
        return Totals(**row.asDict())

    def totals(self) -> Totals:
        done = self._numbers("done")
        return self._read("done", done[-1]) if done else Totals()

    def start(self, batch_id: int, now: datetime) -> datetime:
        """When the batch was begun first; a repeat gets the same time."""
        if batch_id in self._numbers("begun"):
            return datetime.fromisoformat(self._read("begun", batch_id).started)
        self._write("begun", Totals(batch_id=batch_id, started=now.isoformat()))
        return now

    def finish(self, totals: Totals) -> None:
        self._write("done", totals)
        for kind in ("begun", "done"):
            for number in self._numbers(kind)[: -self.keep]:
                self.files.delete(f"{self.path}/{kind}/{number}")

"""Counters of a running job in the progress of its query.

The counts are part of the batch's own plan, so they cost no further pass; Spark hands them over when
the batch is done.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

NAME = "counters"
TASKS = 64  # numbers of tasks that are counted apart; tasks beyond share them


def counted(stream: DataFrame, bad: Column, name: str = NAME, tasks: int = TASKS) -> DataFrame:
    """`stream`, with `consumed` and `dirty` observed for each batch, in all and by task."""
    number = F.pmod(F.spark_partition_id(), F.lit(tasks))
    is_bad = F.coalesce(bad, F.lit(False))
    marked = stream.withColumns({"_task": number, "_dirty": is_bad})
    per_task = [F.count_if(F.col("_task") == i).alias(f"consumed_{i}") for i in range(tasks)]
    per_task += [F.count_if((F.col("_task") == i) & F.col("_dirty")).alias(f"dirty_{i}") for i in range(tasks)]
    return marked.observe(
        name, F.count(F.lit(1)).alias("consumed"), F.count_if(F.col("_dirty")).alias("dirty"), *per_task
    ).drop("_task", "_dirty")


def batch_counts(progress: dict, name: str = NAME) -> dict | None:
    """`batch, consumed, dirty` of one progress report, and `tasks`: the two numbers of each task that had rows."""
    seen = (progress.get("observedMetrics") or {}).get(name)
    if seen is None:
        return None
    told = seen.asDict() if hasattr(seen, "asDict") else dict(seen)
    numbers = [n for n in range(len(told)) if told.get(f"consumed_{n}")]
    tasks = {n: (told[f"consumed_{n}"], told[f"dirty_{n}"]) for n in numbers}
    return {"batch": progress["batchId"], "consumed": told["consumed"], "dirty": told["dirty"], "tasks": tasks}


def counts(query: StreamingQuery, name: str = NAME) -> list[dict]:
    """The counts of the batches whose progress the query still keeps, each batch once."""
    found = {}
    for progress in query.recentProgress:
        told = batch_counts(progress, name)
        if told is not None and progress["numInputRows"]:
            found[told["batch"]] = told
    return [found[b] for b in sorted(found)]


class CounterListener(StreamingQueryListener):
    """Totals of all queries that count under a name, kept up while they run; `tell` is called for each batch."""

    def __init__(self, name: str = NAME, tell: Callable[[dict], None] | None = None):
        self.name, self.tell = name, tell
        self.consumed = self.dirty = 0
        self._lock, self._seen = threading.Lock(), set()

    def onQueryStarted(self, event) -> None:
        """Nothing is counted yet."""

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.name)
        with self._lock:
            # Progress of a query without new rows repeats its last batch.
            if seen is None or not progress.numInputRows or (progress.runId, progress.batchId) in self._seen:
                return
            self._seen.add((progress.runId, progress.batchId))
            self.consumed, self.dirty = self.consumed + seen["consumed"], self.dirty + seen["dirty"]
        if self.tell:
            self.tell({"batch": progress.batchId, "consumed": seen["consumed"], "dirty": seen["dirty"]})

    def onQueryIdle(self, event) -> None:
        """An idle query has nothing to count."""

    def onQueryTerminated(self, event) -> None:
        """Its counts stay."""

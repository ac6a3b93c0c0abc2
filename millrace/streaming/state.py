"""State per key of a stream: buffers that a timer releases, and running totals.

Both run on `transformWithState`, so Spark keeps the state with the checkpoint, restores it after a stop
and gives it to whoever reads the checkpoint by the state source. They need the RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ENTRY_ROWS = 10_000  # rows of a key in one entry of its state, and in one frame of what is released


@contextmanager
def rocksdb(spark: SparkSession):
    """The state store that timers and lists need, for streams started inside."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class _Buffers(StatefulProcessor):
    """Rows wait in a list, each entry with the columns of up to `ENTRY_ROWS` rows, so that a key costs a few calls
    of the state and not one for each row; the first row opens the buffer and sets a timer. Where keys share a
    state, the first `apart` values tell them apart, and the timer is that of the buffer that opened first."""

    def __init__(self, keys: list[T.StructField], values: list[T.StructField], length_us: int, event_time: bool, apart: int = 0):
        self.keys, self.values, self.length, self.event_time, self.apart = keys, values, length_us, event_time, apart

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        columns = [T.StructField("at_us", T.LongType()), *self.values]
        self.rows = handle.getListState("rows", T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in columns]))
        self.opened = handle.getValueState("opened", T.StructType([T.StructField("us", T.LongType())]))

    def _timer(self, opened: int) -> int:
        """Milliseconds at which a buffer is over; rounded up, so that none of its rows is to come."""
        return -(-(opened + self.length) // 1000)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known = self.opened.get()
        before = first = known[0] if known else None
        for frame in rows:
            if not len(frame):
                continue
            us = frame["at_us"].tolist()
            self._wait([us, *(_plain(frame[f.name], f.dataType) for f in self.values)], self.rows.appendList)
            start = min(us) if self.event_time else timerValues.getCurrentProcessingTimeInMs() * 1000
            first = start if first is None else min(first, start)
        if first != before:
            if before is not None:
                self.handle.deleteTimer(self._timer(before))
            self._open(first)
        return iter(())

    def _wait(self, columns: list[list], keep: Any) -> None:
        keep([tuple(c[low : low + ENTRY_ROWS] for c in columns) for low in range(0, len(columns[0]), ENTRY_ROWS)])

    def _open(self, us: int) -> None:
        self.opened.update((us,))
        self.handle.registerTimer(self._timer(us))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        entries = list(self.rows.get())
        at_us, *values = ([v for entry in entries for v in entry[place]] for place in range(len(self.values) + 1))
        if self.event_time:
            order = sorted(range(len(at_us)), key=at_us.__getitem__)
            opened = self._buffers(order, at_us, values, timerValues.getCurrentWatermarkInMs())
        else:
            order, opened = range(len(at_us)), [self.opened.get()[0]] * len(at_us)
        over = [(i, us) for i, us in zip(order, opened) if us is not None]
        for low in range(0, len(over), ENTRY_ROWS):
            part = over[low : low + ENTRY_ROWS]
            yield self._released(key, [us for _, us in part], [[c[i] for i, _ in part] for c in values])
        # The timer that fired is gone, so it is not to be deleted.
        left = [i for i, us in zip(order, opened) if us is None]
        if left:
            self._wait([[c[i] for i in left] for c in (at_us, *values)], self.rows.put)
            self._open(at_us[left[0]])
        else:
            self.opened.clear()
            self.rows.clear()

    def _buffers(self, order: list[int], at_us: list[int], values: list[list], now: int) -> list[int | None]:
        """Where the buffer of each row opened, null where it is not over; rows that came early may fill several
        that are."""
        keys = list(zip(*values[: self.apart])) if self.apart else [()] * len(order)
        begun, opened = {}, []
        for i in order:
            start = begun.get(keys[i])
            if start is None or at_us[i] >= start + self.length:
                start = begun[keys[i]] = at_us[i]
            opened.append(start if self._timer(start) <= now else None)
        return opened

    def _released(self, key: Any, opened: list[int], values: list[list]) -> pd.DataFrame:
        # Objects, as numbers beside nulls would turn into doubles.
        columns = {f.name: pd.Series([value] * len(opened), dtype=object) for f, value in zip(self.keys, key)}
        columns |= {f.name: pd.Series(c, dtype=object) for f, c in zip(self.values, values)}
        return pd.DataFrame({**columns, "opened_us": opened})

    def close(self) -> None:
        pass


def _plain(column: pd.Series, kind: T.DataType) -> list:
    """Values as state takes them: no numpy numbers, no NaN for null, no doubles for whole numbers beside nulls."""
    values = [None if v is None or v != v else v for v in column.tolist()]
    if isinstance(kind, T.IntegralType) and column.dtype.kind == "f":
        return [None if v is None else int(v) for v in values]
    return values


def keyed_buffers(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    seconds: float,
    values: Sequence[str],
    late: str = "0 seconds",
    event_time: bool = True,
    groups: int | None = None,
) -> DataFrame:
    """Rows of a stream, held back per key and released together: a key's buffer opens with its first row and
    is released `seconds` later, when the watermark (`late` behind the newest row) has passed that, or by
    the clock where `event_time` is off. The next row opens the next buffer.

    Gives `keys, values, opened_us`, the microseconds at which the row's buffer opened (by the row, or by the
    clock). A key holds the rows of one interval and of the lateness allowed. Rows behind the watermark are
    left out by Spark and counted in the query's progress. Rows without a time stay out; null keys are a key.
    Start it inside `rocksdb`.

    A state costs some calls a batch. With `groups`, keys share that many states by their hash, which saves most of
    them where keys are many and have few rows each; in turn a release reads and writes what waits in its group.
    The rows given are the same. It goes by event time, with keys that are no fractions and not nested.
    """
    # Plain names inside, as the caller's may be any.
    inner = {**{f"k{i}": k for i, k in enumerate(keys)}, **{f"v{i}": v for i, v in enumerate(values)}}
    named = [F.col(f"`{name}`").alias(to) for to, name in inner.items()]
    timed = stream.where(F.col(ts).isNotNull()).select(*named, F.col(ts).cast("timestamp").alias("ts"))
    if event_time:
        timed = timed.withWatermark("ts", late)
    timed = timed.withColumn("at_us", F.unix_micros("ts"))
    fields = [T.StructField(name, timed.schema[name].dataType) for name in inner]
    key_fields, value_fields = fields[: len(keys)], fields[len(keys) :]
    apart = 0
    if groups:
        unfit = (T.FloatType, T.DoubleType, T.ArrayType, T.MapType, T.StructType)
        if not event_time or any(isinstance(f.dataType, unfit) for f in key_fields):
            raise ValueError("groups need event time and plain keys")
        timed = timed.withColumn("g", F.pmod(F.xxhash64(*[f.name for f in key_fields]), F.lit(groups)))
        apart, key_fields, value_fields = len(keys), [], fields
    held = timed.groupBy(*(["g"] if groups else [f.name for f in key_fields])).transformWithStateInPandas(
        _Buffers(key_fields, value_fields, round(seconds * 1_000_000), event_time, apart),
        T.StructType([*fields, T.StructField("opened_us", T.LongType())]),
        "Append",
        "EventTime" if event_time else "ProcessingTime",
    )
    return held.select(*[F.col(to).alias(name) for to, name in inner.items()], "opened_us")


class _Totals(StatefulProcessor):
    """Two numbers for each key: records and bad records so far."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", T.StructType([T.StructField(n, T.LongType()) for n in ("consumed", "dirty")]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        consumed, dirty = self.totals.get() if self.totals.exists() else (0, 0)
        for frame in rows:
            consumed, dirty = consumed + len(frame), dirty + int(frame["is_bad"].sum())
        self.totals.update((consumed, dirty))
        yield pd.DataFrame({"key": [key[0]], "consumed": [consumed], "dirty": [dirty]})

    def close(self) -> None:
        pass


def keyed_totals(stream: DataFrame, key: str, bad: Any) -> DataFrame:
    """`key, consumed, dirty` of each key that a batch brings rows of: its totals since the stream's
    beginning, which survive a stop. Start it inside `rocksdb`, in update mode; `stored_totals` reads all."""
    rows = stream.select(F.col(key).cast("string").alias("key"), F.coalesce(bad, F.lit(False)).alias("is_bad"))
    return rows.groupBy("key").transformWithStateInPandas(_Totals(), "key string, consumed long, dirty long", "Update", "None")


def stored_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """`key, consumed, dirty` of all keys, from the state of a stopped or running stream."""
    state = spark.read.format("statestore").option("stateVarName", "totals").load(checkpoint)
    return state.select(F.col("key.key").alias("key"), "value.consumed", "value.dirty")

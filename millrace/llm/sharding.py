"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots, whose number never changes. A small table, written as a
numbered version, says which shard holds each slot. Rebalancing adds up the bytes of the slots and
edits the table: slots move from the fullest shard to the emptiest, and no other record moves.

What reaches the driver is one row per slot, whatever the input. Defined results: null text counts as
no bytes; null keys are hashed as such; equal rows share a slot; an empty table gives no rows and the
even map; other columns may have any name, since only the named ones are read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path, written

SLOTS = 4096


def even_map(shards: int, slots: int = SLOTS) -> list[int]:
    """The first version of a map: slots in equal runs."""
    return [s * shards // slots for s in range(slots)]


def rebalanced(shard_of: Sequence[int], load: Sequence[int], shards: int) -> list[int]:
    """The map edited until no single move brings the fullest and the emptiest shard nearer.

    Each edit moves, from the fullest shard to the emptiest, the slot whose load is nearest to half
    their difference. Shards that the map does not name yet are empty and fill up this way.
    """
    edited = list(shard_of)
    held = [set() for _ in range(shards)]
    total = [0] * shards
    for slot, shard in enumerate(edited):
        if load[slot]:
            held[shard].add(slot)
        total[shard] += load[slot]
    while True:
        full = max(range(shards), key=lambda i: (total[i], -i))
        bare = min(range(shards), key=lambda i: (total[i], i))
        gap = total[full] - total[bare]
        fits = [s for s in held[full] if load[s] < gap]
        if not fits:
            return edited
        slot = min(fits, key=lambda s: (abs(2 * load[s] - gap), s))
        held[full].remove(slot)
        held[bare].add(slot)
        total[full] -= load[slot]
        total[bare] += load[slot]
        edited[slot] = bare


def slot_of(keys: Sequence[Column], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def slot_loads(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot of `rows` with `_slot` and `_size`."""
    size, count = [0] * slots, [0] * slots
    for r in rows.groupBy("_slot").agg(F.sum("_size").alias("s"), F.count(F.lit(1)).alias("n")).collect():
        size[r["_slot"]], count[r["_slot"]] = r["s"], r["n"]
    return size, count


class SlotMap:
    """Versions of a slot-to-shard map, kept as Parquet below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def save(self, version: int, shard_of: Sequence[int], first_row: Sequence[int] | None = None) -> None:
        first_row = first_row or [0] * len(shard_of)
        entries = json.dumps([{"s": s, "f": f} for s, f in zip(shard_of, first_row)])
        parsed = F.from_json(F.lit(entries), "array<struct<s:int,f:bigint>>")
        rows = self.spark.range(1, numPartitions=1).select(F.posexplode(parsed).alias("_slot", "_entry"))
        rows = rows.select("_slot", F.col("_entry.s").alias("_shard"), F.col("_entry.f").alias("_first"))
        rows.write.mode("overwrite").parquet(f"{self.path}/version={version}")

    def load(self, version: int) -> DataFrame:
        """One row per slot, so it may be broadcast."""
        return F.broadcast(self.spark.read.parquet(f"{self.path}/version={version}"))


def first_rows(shard_of: Sequence[int], rows: Sequence[int], shards: int) -> list[int]:
    """Where the rows of each slot begin within its shard."""
    begun, first = [0] * shards, []
    for slot, shard in enumerate(shard_of):
        first.append(begun[shard])
        begun[shard] += rows[slot]
    return first


def shard_records(
    docs: DataFrame, keys: Sequence[str], size: Column, carry: dict[str, Column], shards: int = 8, slots: int = SLOTS
) -> DataFrame:
    """`carry` columns with `_size`, `_slot`, `_shard`, `_place` (from 0 within the shard), `_version`.

    Version 1 of the map is even, version 2 is edited by the bytes of the slots. Records are numbered
    within their slot, and a slot begins where the one before it in its shard ends.
    """
    columns = [c.alias(n) for n, c in carry.items()]
    found = docs.select(*columns, size.alias("_size"), slot_of([F.col(k) for k in keys], slots).alias("_slot"))
    rows = written(found, "slots")
    load, count = slot_loads(rows, slots)
    maps = SlotMap(docs.sparkSession, scratch_path(docs.sparkSession, "slot-map"))
    maps.save(1, even_map(shards, slots))
    edited = rebalanced(even_map(shards, slots), load, shards)
    maps.save(2, edited, first_rows(edited, count, shards))
    order = Window.partitionBy("_slot").orderBy(*carry, "_size")
    placed = rows.withColumn("_in_slot", F.row_number().over(order) - 1).join(maps.load(2), "_slot")
    return placed.select(
        *carry,
        "_size",
        "_slot",
        "_shard",
        (F.col("_first") + F.col("_in_slot")).alias("_place"),
        F.lit(2).alias("_version"),
    )


def write_shards(docs: DataFrame, keys: Sequence[str], path: str, slot_map: DataFrame, slots: int = SLOTS) -> None:
    """Write records below one folder per shard, as a stored version of the map says. `slot_map` is
    what `SlotMap.load` gives; partitions are split by size at run time, also for a large shard."""
    placed = docs.withColumn("_slot", slot_of([F.col(k) for k in keys], slots)).join(slot_map, "_slot")
    out = placed.drop("_slot", "_first").withColumnRenamed("_shard", "shard")
    out.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)

"""A table of one row per key that takes batches of changes, kept as plain Parquet files.

A batch is appended as one row per changed key, so what it writes follows its own size. Now and then
the changes are folded into the base, which lies in hash buckets of the key; only buckets with changes
are written again, as a new version. Readers see base and changes together, by the same merges that
work on any two frames. One writer at a time.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.keys import stable_salt
from ..operators.changes import apply_batch, latest_changes, patches, replay_patches, upsert_patch
from ..operators.layout import spread_for_write
from .fs import Files

# A bucket's row names the version of its files. Rows of bucket -1 name a job and its last folded batch,
# or with no job the number of the last folded change set and the number of buckets.
_MANIFEST = "bucket int, version long, job string, batch_id long"
ORDER = "_order"


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        buckets: int = 64,
        patch: bool = False,
    ):
        """`buckets` counts when the first fold makes the base; afterwards the stored number does.
        With `patch`, changes overwrite only the fields that they carry."""
        self.spark, self.schema, self.keys, self.patch = spark, schema, list(keys), patch
        self.files = Files(spark, path)
        self.path = self.files.qualified(path)
        self._asked = buckets

    # What is stored

    def versions(self) -> list[int]:
        """Published versions of the base, oldest first."""
        found = self.files.names(f"{self.path}/_versions")
        done = [n for n in found if self.files.exists(f"{self.path}/_versions/{n}/_SUCCESS")]
        return sorted(int(n.removeprefix("v=")) for n in done)

    def _entries(self, version: int) -> list:
        """One entry per bucket that has rows, and a few marks."""
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/_versions/v={version}").collect()

    def _state(self) -> tuple[dict[int, int], dict[str, int], int, int]:
        """Version of each bucket, last folded batch of each job, last folded change set, buckets."""
        versions = self.versions()
        entries = self._entries(versions[-1]) if versions else []
        live = {r["bucket"]: r["version"] for r in entries if r["bucket"] >= 0}
        marks = {r["job"]: r["batch_id"] for r in entries if r["bucket"] < 0 and r["job"] is not None}
        last = next(((r["batch_id"], r["version"]) for r in entries if r["bucket"] < 0 and r["job"] is None), (0, self._asked))
        return live, marks, *last

    def _change_sets(self) -> list[tuple[int, str, int]]:
        """Number, job and batch of each complete change set that is kept, oldest first."""
        found = []
        for name in self.files.names(f"{self.path}/changes"):
            number, job, batch = name.split("_", 2)[0], name[13:].rpartition("_")[0], name.rpartition("_")[2]
            if self.files.exists(f"{self.path}/changes/{name}/_SUCCESS"):
                found.append((int(number), job, int(batch)))
        return found

    def _folder(self, number: int, job: str, batch_id: int) -> str:
        return f"{self.path}/changes/{number:012d}_{job}_{batch_id}"

    def _changes(self, after: int) -> tuple[DataFrame | None, list[tuple[int, str, int]]]:
        """Changes of the sets above a number, with their order."""
        sets = [s for s in self._change_sets() if s[0] > after]
        frames = [self.spark.read.parquet(self._folder(*s)).withColumn(ORDER, F.lit(s[0])) for s in sets]
        if not frames:
            return None, []
        together = frames[0]
        for frame in frames[1:]:
            together = together.unionByName(frame, allowMissingColumns=True)
        return together, sets

    def _base(self, live: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/data/v={v}/bucket={b}" for b, v in live.items()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _merged(self, base: DataFrame, found: DataFrame) -> DataFrame:
        if self.patch:
            rows = replay_patches(found, self.keys, ORDER)
            return upsert_patch(base, rows, self.keys, ORDER, F.col("_gone"))
        return apply_batch(base, found, self.keys, ORDER, F.col("_gone"))

    def read(self) -> DataFrame:
        live, _, folded, _ = self._state()
        found, _ = self._changes(folded)
        base = self._base(live)
        return base if found is None else self._merged(base, found)

    # Changes

    def apply(
        self,
        changes: DataFrame,
        seq: str,
        batch_id: int,
        delete: Column | None = None,
        order: str = "sequence",
        job: str = "",
    ) -> bool:
        """Append a batch once; false if it was appended before. Batch numbers count within a job, so
        a new job, or one with a new checkpoint, begins again without losing anything."""
        _, marks, folded, _ = self._state()
        sets = self._change_sets()
        if batch_id <= marks.get(job, -1) or (job, batch_id) in {s[1:] for s in sets}:
            return False
        number = max([folded, *[s[0] for s in sets]]) + 1
        if self.patch:
            reduced = patches(changes, [f.name for f in self.schema], self.keys, seq, delete)
        else:
            reduced = latest_changes(changes, [f.name for f in self.schema], self.keys, seq, delete, order)
        reduced.write.mode("overwrite").parquet(self._folder(number, job, batch_id))
        return True

    def _bucket(self, buckets: int) -> Column:
        return stable_salt(F.concat_ws("\x1f", *[F.col(k).cast("string") for k in self.keys]), buckets)

    def fold(self) -> bool:
        """Take the changes into the base; false if there are none."""
        live, marks, folded, buckets = self._state()
        found, sets = self._changes(folded)
        if found is None:
            return False
        versions = self.versions()
        version = (versions[-1] if versions else 0) + 1
        touched = {r["b"] for r in found.select(self._bucket(buckets).alias("b")).distinct().collect()}
        merged = self._merged(self._base({b: v for b, v in live.items() if b in touched}), found)
        target = f"{self.path}/data/v={version}"
        bucketed = spread_for_write(merged.withColumn("bucket", self._bucket(buckets)), ["bucket"])
        bucketed.write.mode("overwrite").partitionBy("bucket").parquet(target)
        filled = {int(n.removeprefix("bucket=")) for n in self.files.names(target) if n.startswith("bucket=")}
        live = {b: v for b, v in live.items() if b not in touched} | {b: version for b in filled}
        for _, job, batch in sets:
            marks[job] = max(batch, marks.get(job, -1))
        rows = [(b, v, None, 0) for b, v in sorted(live.items())]
        rows += [(-1, 0, j, n) for j, n in sorted(marks.items())] + [(-1, buckets, None, sets[-1][0])]
        manifest = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.path}/_versions/v={version}")
        return True

    def vacuum(self, keep_seconds: float = 3600, now: float | None = None) -> None:
        """Drop what the newest version no longer needs and what is older than `keep_seconds`, so that
        readers that began before the last fold can end."""
        before = (time.time() if now is None else now) - keep_seconds
        versions = self.versions()
        if not versions:
            return
        old = [v for v in versions[:-1] if self.files.modified(f"{self.path}/_versions/v={v}") < before]
        kept = [v for v in versions if v not in old]
        used = {(r["bucket"], r["version"]) for v in kept for r in self._entries(v) if r["bucket"] >= 0}
        for version in old:
            self.files.delete(f"{self.path}/_versions/v={version}")
        for name in self.files.names(f"{self.path}/data"):
            version = int(name.removeprefix("v="))
            if version >= versions[-1] or self.files.modified(f"{self.path}/data/{name}") >= before:
                continue
            folders = [n for n in self.files.names(f"{self.path}/data/{name}") if n.startswith("bucket=")]
            live = [n for n in folders if (int(n.removeprefix("bucket=")), version) in used]
            if not live:
                self.files.delete(f"{self.path}/data/{name}")
                continue
            for folder in set(folders) - set(live):
                self.files.delete(f"{self.path}/data/{name}/{folder}")
        folded = self._state()[2]
        for found in self._change_sets():
            folder = self._folder(*found)
            if found[0] <= folded and self.files.modified(folder) < before:
                self.files.delete(folder)

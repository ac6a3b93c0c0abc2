"""A keyed catalog table whose rows lie in partitions and buckets of their key.

Spark's own layout does the work: a merge joins the stored rows bucket by bucket, so they are read where
they are and only the batch is shuffled, also where it is too large to broadcast. Partitions that a batch
touches are written again by dynamic overwrite; others are not read. The table holds no marks: a batch
that comes again gives the same rows. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions.keys import stable_salt
from ..operators.changes import apply_batch, latest_changes, patches, replay_patches, upsert_patch
from ..session import written

PART = "_part"
ORDER = "_order"


@contextmanager
def _dynamic(spark: SparkSession):
    """Overwriting leaves partitions alone that get no rows. A setting and not an option of the write, as only
    then a table may be read by what overwrites it."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class BucketedTable:
    """`partitions` and `buckets` count when the table is made; afterwards the stored numbers do. A
    partition is the least that a merge writes, a bucket the most that one of its tasks holds."""

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        schema: T.StructType,
        keys: Sequence[str],
        partitions: int = 64,
        buckets: int = 16,
        patch: bool = False,
        path: str | None = None,
    ):
        self.spark, self.name, self.schema, self.keys, self.patch = spark, name, schema, list(keys), patch
        if not spark.catalog.tableExists(name):
            made = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())]))
            writer = made.write.format("parquet").partitionBy(PART).bucketBy(buckets, *self.keys).sortBy(*self.keys)
            if path:
                writer = writer.option("path", path)
            writer.saveAsTable(name)
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('millrace.partitions' = '{partitions}')")
        told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        self.partitions = int(told.get("millrace.partitions", partitions))
        rows = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
        self.buckets = int(rows[0]["data_type"]) if rows else buckets

    def part(self) -> Column:
        key = F.concat_ws("\x1f", *[F.col(k).cast("string") for k in self.keys])
        return stable_salt(key, self.partitions).cast("int")

    def read(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.schema.names)

    def merged(self, changes: DataFrame, touched: Sequence[int]) -> DataFrame:
        """The rows of the touched partitions after changes that `reduced` gave."""
        stored = self.spark.table(self.name).where(F.col(PART).isin(*touched)).select(*self.schema.names)
        # Dealt as the buckets are, so that neither side of the join moves again.
        dealt = changes.repartition(self.buckets, *self.keys)
        merge = upsert_patch if self.patch else apply_batch
        return merge(stored, dealt, self.keys, ORDER, F.col("_gone"))

    def reduced(self, changes: DataFrame, seq: str, delete: Column | None, order: str) -> DataFrame:
        """A batch as one change of each key, with `_gone` and `ORDER`."""
        if self.patch:
            summed = patches(changes, self.schema.names, self.keys, seq, delete).withColumn(ORDER, F.lit(0))
            return replay_patches(summed, self.keys, ORDER)
        return latest_changes(changes, self.schema.names, self.keys, seq, delete, order).withColumn(ORDER, F.lit(0))

    def apply(
        self,
        changes: DataFrame,
        seq: str,
        batch_id: int = 0,
        delete: Column | None = None,
        order: str = "sequence",
        job: str = "",
    ) -> bool:
        """Apply a batch; false if it has no changes. A repeat of the last batch changes nothing."""
        batch = written(self.reduced(changes, seq, delete, order), "batch")
        touched = sorted(r[0] for r in batch.select(self.part()).distinct().collect())  # at most `partitions`
        if not touched:
            return False
        seen = Observation()
        rows = self.merged(batch, touched).withColumn(PART, self.part())
        rows = rows.observe(seen, F.collect_set(PART).alias("parts"))
        with _dynamic(self.spark):
            rows.write.insertInto(self.name, overwrite=True)
        # Overwriting leaves a partition alone that has no rows any more.
        stored = {int(r[0].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}
        for part in sorted((set(touched) - set(seen.get["parts"])) & stored):
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({PART} = {part})")
        self.spark.catalog.refreshTable(self.name)
        return True

    def fold(self) -> bool:
        """Nothing waits to be folded."""
        return False

    def vacuum(self, keep_seconds: float = 3600, now: float | None = None) -> None:
        """Nothing is kept that is not read."""

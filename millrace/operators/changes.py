"""Keyed changes and their application to a table.

Every merge reduces the changes to one row per key by a partial aggregate first, so a
key with very many changes is thinned out before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..spec import SchemaSpec

DELETE_FLAG = "is_delete"


def is_delete(schema: SchemaSpec) -> Column:
    """Whether a row deletes: all rows in DELETE mode, the marked ones in MIX mode."""
    if schema.mode == "MIX":
        return F.coalesce(F.upper(F.col(schema.op_field)) == "DELETE", F.lit(False))
    return F.lit(schema.mode == "DELETE")


def classify_op(df: DataFrame, schema: SchemaSpec) -> DataFrame:
    """Adds the delete flag and drops the operation column."""
    flagged = df.withColumn(DELETE_FLAG, is_delete(schema))
    return flagged.drop(schema.op_field) if schema.is_mix else flagged


def latest_per_key(
    changes: DataFrame, keys: Sequence[str], seq: str | Column, where: Column | None = None
) -> DataFrame:
    """The newest change of every key, with all its columns. `seq` is unique per key."""
    order = F.col(seq) if isinstance(seq, str) else seq
    if where is not None:
        changes = changes.where(where)
    rest = [c for c in changes.columns if c not in keys]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return newest.select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest])


def _replaced(target: DataFrame, changes: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows of keys that `changes` does not name, and the rows that changed keys end with.

    The stored side is only ever the left of an anti join, so that Spark may broadcast a small
    batch's keys and leave the stored rows where they are.
    """
    named = changes.select(*keys).distinct()
    untouched = target.join(named, list(keys), "left_anti").select(*target.columns)
    return untouched.union(changed.select(*target.columns))


def upsert_replace(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    delete: Column | None = None,
) -> DataFrame:
    """Whole rows replaced by the newest change of their key; the last change decides
    whether the row stays. `changes` has the columns of `target`, `seq` and whatever
    `delete` reads."""
    return apply_batch(target, changes, keys, seq, delete, order="sequence")


def latest_changes(
    changes: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    seq: str,
    delete: Column | None = None,
    order: str = "sequence",
) -> DataFrame:
    """The change of every key that counts, with `_gone` where it deletes.

    `sequence`: the newest change of each key. `delete_first`: all deletes come before all upserts, so a
    key with any upsert in the batch stays.
    """
    gone = F.lit(False) if delete is None else F.coalesce(delete, F.lit(False))
    values = [c for c in columns if c not in keys]
    flagged = changes.select(*keys, F.col(seq).alias("_seq"), gone.alias("_gone"), *values)
    if order == "sequence":
        newest = latest_per_key(flagged, keys, "_seq")
    elif order == "delete_first":
        # Upserts outrank deletes whatever their sequence.
        newest = latest_per_key(flagged, keys, F.struct(~F.col("_gone"), F.col("_seq")))
    else:
        raise ValueError(f"order [{order}] is neither sequence nor delete_first")
    return newest.drop("_seq")


def apply_batch(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    delete: Column | None = None,
    order: str = "sequence",
) -> DataFrame:
    """A batch of whole-row changes applied to a table; `order` as for `latest_changes`."""
    newest = latest_changes(changes, target.columns, keys, seq, delete, order)
    return _replaced(target, changes, newest.where(~F.col("_gone")), keys)


def patches(
    changes: DataFrame, columns: Sequence[str], keys: Sequence[str], seq: str, delete: Column | None = None
) -> DataFrame:
    """What a batch of patches comes to for every key: `_cleared` if it deletes the row, `_alive` if
    the row is there after it, and the values it carries since.

    A delete clears the row, so only changes after a key's last delete count. Since the newest value of
    a field is the only one that can survive, one aggregate per field and the sequence of the last
    delete are enough, without a window.
    """
    gone = F.lit(False) if delete is None else F.coalesce(delete, F.lit(False))
    values = [c for c in columns if c not in keys and c in changes.columns]
    flagged = changes.select(*keys, F.col(seq).alias("_seq"), gone.alias("_gone"), *values)
    upsert = ~F.col("_gone")

    def newest(name: str) -> Column:
        pair = F.when(upsert & F.col(name).isNotNull(), F.struct("_seq", name))
        return F.max_by(pair, F.when(pair.isNotNull(), F.col("_seq"))).alias(name)

    summed = flagged.groupBy(*keys).agg(
        F.max(F.when(F.col("_gone"), F.col("_seq"))).alias("_deleted_at"),
        F.max(F.when(upsert, F.col("_seq"))).alias("_upsert_at"),
        *[newest(name) for name in values],
    )
    deleted_at = F.col("_deleted_at")
    later = lambda name: deleted_at.isNull() | (F.col(name).getField("_seq") > deleted_at)
    return summed.select(
        *keys,
        deleted_at.isNotNull().alias("_cleared"),
        (F.col("_upsert_at").isNotNull() & (deleted_at.isNull() | (F.col("_upsert_at") > deleted_at))).alias("_alive"),
        *[F.when(later(name), F.col(name).getField(name)).alias(name) for name in values],
    )


def replay_patches(summed: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """What `patches` gave for several batches as changes again: of each row a delete if it clears,
    then an upsert if the row is alive. `order` numbers the batches."""
    steps = F.array_compact(
        F.array(
            F.when(F.col("_cleared"), F.struct((F.col(order) * 2).alias("n"), F.lit(True).alias("gone"))),
            F.when(F.col("_alive"), F.struct((F.col(order) * 2 + 1).alias("n"), F.lit(False).alias("gone"))),
        )
    )
    values = [c for c in summed.columns if c not in (*keys, order, "_cleared", "_alive")]
    return summed.select(*keys, *values, F.explode(steps).alias("_step")).select(
        *keys, *values, F.col("_step.n").alias(order), F.col("_step.gone").alias("_gone")
    )


def upsert_patch(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    delete: Column | None = None,
) -> DataFrame:
    """Only the fields a change carries are overwritten; null means not carried."""
    values = [c for c in target.columns if c not in keys and c in changes.columns]
    patch = patches(changes, target.columns, keys, seq, delete)
    # Of the stored rows only those of changed keys are needed to fill up what a patch leaves out.
    old = target.join(changes.select(*keys).distinct(), list(keys), "left_semi").withColumn("_stored", F.lit(True))
    joined = patch.alias("c").join(old.alias("t"), list(keys), "left")
    cleared, stored = F.col("c._cleared"), F.coalesce(F.col("t._stored"), F.lit(False))

    def pick(name: str) -> Column:
        kept = F.when(~cleared, F.col(f"t.{name}"))
        return F.coalesce(F.col(f"c.{name}"), kept) if name in values else kept

    merged = joined.where(F.col("c._alive") | (stored & ~cleared)).select(
        *[F.col(k) if k in keys else pick(k).alias(k) for k in target.columns]
    )
    return _replaced(target, changes, merged, keys)


def delete_by_key(target: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the deleted ones; unknown keys do no harm."""
    return target.join(deletes.select(*keys).distinct(), list(keys), "left_anti")

"""Checks on messages, bad rows apart from good ones, and what is counted about them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions import convert
from ..functions.text import has_slash, is_blank
from ..spec import (
    CHECK_DIRTY_ERROR,
    DIRTY_COUNT_ERROR,
    FROM_KEY,
    MESSAGE_BREAK,
    OBJECT_KEY,
    OPERATIONS,
    PARSE_ERROR,
    TO_KEY,
    TYPE_ERROR,
    FieldSpec,
    SchemaSpec,
)
from .extract import extract

# Fields of an error row, in order.
ENVELOPE_FIELDS = (
    "id",
    "object_key",
    "task_instance_id",
    "error_type",
    "error_log",
    "affected_store",
    "data_row",
    "updated_dt",
)

Check = tuple[Column, str, Column]


class DirtyLimitExceeded(RuntimeError):
    """More bad rows than the job allows."""


def _dirty(condition: Column, message: str | Column) -> Check:
    return condition, CHECK_DIRTY_ERROR, F.lit(message) if isinstance(message, str) else message


def check_key(name: str = OBJECT_KEY) -> list[Check]:
    """A key is present and holds no slash."""
    return [
        _dirty(is_blank(F.col(name)), f"{name} is missing or blank"),
        _dirty(has_slash(F.col(name)), f"{name} must not contain a slash"),
    ]


def check_edge() -> list[Check]:
    """Both ends of an edge are proper keys."""
    return check_key(FROM_KEY) + check_key(TO_KEY)


def check_operation(op_field: str) -> list[Check]:
    """The operation is present and known, in any case."""
    op = F.col(op_field)
    return [
        _dirty(is_blank(op), f"{op_field} is missing or blank"),
        _dirty(~F.upper(op).isin(*OPERATIONS), F.concat(F.lit(f"{op_field} is not an operation: "), op)),
    ]


def check_required(fields: Sequence[FieldSpec], blank_is_null: bool = False) -> list[Check]:
    """Required fields are not null; an empty text counts as a value unless told otherwise."""
    return [
        _dirty(
            is_blank(F.col(f.target)) if blank_is_null else F.col(f.target).isNull(),
            f"required field {f.source} is missing",
        )
        for f in fields
        if f.required
    ]


def check_types(fields: Sequence[FieldSpec]) -> list[Check]:
    """Present values fit their declared types."""
    checks = []
    for f in fields:
        if f.type in ("DOUBLE", "LONG"):
            raw = F.col(f.target)
            failed = convert.conversion_failed(raw, f.type)
            checks.append((failed, TYPE_ERROR, F.concat(F.lit(f"{f.source} is not a {f.type}: "), raw)))
    return checks


def first_error(checks: Sequence[Check]) -> Column:
    """`struct<code, message>` of the first check that fires, null where none does."""
    result = None
    for condition, code, message in checks:
        error = F.struct(F.lit(code).alias("code"), message.alias("message"))
        result = F.when(condition, error) if result is None else result.when(condition, error)
    return result


def schema_checks(schema: SchemaSpec) -> list[Check]:
    """All checks in order: form, key, edge ends, operation, required fields, types."""
    checks = [(F.col("malformed"), PARSE_ERROR, F.lit("message is not a JSON object"))]
    checks += check_key()
    if schema.is_edge:
        checks += check_edge()
    if schema.is_mix:
        checks += check_operation(schema.op_field)
    checks += check_required(schema.fields, schema.blank_is_null)
    checks += check_types(schema.fields)
    return checks


def validate(
    df: DataFrame, schema: SchemaSpec, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Messages checked and converted in one pass over the text.

    Columns: the kept ones, `raw`, `key` (object key text, null if unfit), `record`
    (declared fields, typed) and `error` (null for good rows).
    """
    texts = extract(df, schema.fields, value, keep)
    key = F.col(OBJECT_KEY)
    record = F.struct(*[convert.convert(F.col(f.target), f.type).alias(f.target) for f in schema.fields])
    return texts.select(
        *keep,
        "raw",
        F.when(~is_blank(key) & ~has_slash(key), key).alias("key"),
        record.alias("record"),
        first_error(schema_checks(schema)).alias("error"),
    )


def clean_rows(validated: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Good rows as typed columns."""
    return validated.where(F.col("error").isNull()).select(*keep, "record.*")


def clean_json(validated: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Good rows as JSON texts; null fields are left out."""
    good = validated.where(F.col("error").isNull())
    return good.select(*keep, F.to_json("record").alias("value"))


def error_envelope(
    validated: DataFrame,
    task_instance_id: str,
    affected_store: str,
    updated_dt: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Bad rows as error rows of eight texts. The time is given, so that a repeat agrees."""
    key = F.coalesce("key", F.lit("null"))
    bad = validated.where(F.col("error").isNotNull())
    return bad.select(
        *keep,
        F.concat(key, F.lit(f"_{affected_store}")).alias("id"),
        key.alias("object_key"),
        F.lit(task_instance_id).alias("task_instance_id"),
        F.col("error.code").alias("error_type"),
        F.col("error.message").alias("error_log"),
        F.lit(affected_store).alias("affected_store"),
        F.col("raw").alias("data_row"),
        F.lit(updated_dt).alias("updated_dt"),
    )


def envelope_json(envelopes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return envelopes.select(*keep, F.to_json(F.struct(*ENVELOPE_FIELDS)).alias("value"))


def split_clean_dirty(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good and bad rows of a validated frame; persist it first if both are used."""
    return (
        validated.where(F.col("error").isNull()),
        validated.where(F.col("error").isNotNull()),
    )


def count_metrics(validated: DataFrame, observation: Observation | str) -> DataFrame:
    """The frame with `consumed` and `dirty` counted on the way through."""
    return validated.observe(
        observation,
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(F.col("error").isNotNull()).alias("dirty"),
    )


def consumed_by(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Rows taken in per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("consumed"))


def dirty_by(validated: DataFrame, *keys: Column | str) -> DataFrame:
    """Rows taken in and bad rows per key."""
    return validated.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(F.col("error").isNotNull()).alias("dirty"),
    )


def counts_by_task(validated: DataFrame) -> DataFrame:
    """Consumed and bad rows per partition of the frame."""
    return dirty_by(validated, F.spark_partition_id().alias("task"))


def cap_dirty(dirty: DataFrame, limit: int, order: Sequence[str], already_stored: int = 0) -> DataFrame:
    """The first bad rows in order, as many as the budget still allows."""
    return dirty.orderBy(*order).limit(max(0, limit - already_stored))


def fail_over(dirty_total: int, handle_mode: int) -> None:
    """Stop the job when more rows are bad than allowed; -1 allows any number."""
    if 0 <= handle_mode < dirty_total:
        raise DirtyLimitExceeded(
            f"{DIRTY_COUNT_ERROR}{MESSAGE_BREAK}{dirty_total} bad rows are over the limit of {handle_mode}"
        )

"""Messages made from the given tables, some of them spoiled in known ways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.spec import FieldSpec, SchemaSpec

_FIELDS = (
    FieldSpec("$.from_key", "from_key", "STRING", True),
    FieldSpec("$.to_key", "to_key", "STRING", True),
    FieldSpec("$.reading.amount", "total", "LONG", True),
    FieldSpec("$.reading.share", "ratio", "DOUBLE", False),
    FieldSpec("$.object_key", "object_key", "STRING", True),
)
_OPERATION = FieldSpec("$._operation", "_operation", "STRING", True)

VERTEX = SchemaSpec(fields=_FIELDS[2:], kind="vertex", mode="UPSERT")
EDGE = SchemaSpec(fields=_FIELDS, kind="edge", mode="UPSERT")
EDGE_MIX = SchemaSpec(fields=(*_FIELDS, _OPERATION), kind="edge", mode="MIX", op_field="_operation")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def operation(event_type: Column) -> Column:
    return (
        F.when(event_type == "signup", "ADD")
        .when(event_type == "click", "UPDATE")
        .when(event_type == "error", "DELETE")
        .otherwise("UPSERT")
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`event_id, user_id, value`: one JSON message per event. The last digit of the
    event says what is wrong with it, if anything."""
    events = table(spark, sf_dir, "events")
    spoil = F.col("event_id") % 10
    event = F.col("event_id").cast("string")

    def spoiled(digit: int, bad, good: Column) -> Column:
        return F.when(spoil == digit, F.lit(bad)).otherwise(good)

    amount = F.col("value")
    document = F.struct(
        spoiled(4, " ", F.concat(F.lit("u"), F.col("user_id"))).alias("from_key"),
        spoiled(5, "x/y", F.col("event_type")).alias("to_key"),
        F.struct(
            F.when(spoil == 2, "abc").when(spoil != 3, amount.cast("string")).alias("amount"),
            F.when(spoil != 7, amount).alias("share"),
        ).alias("reading"),
        F.when(spoil == 1, F.concat(F.lit("a/"), event))
        .when(spoil != 0, F.concat(F.lit("k"), event))
        .alias("object_key"),
        spoiled(6, "123", operation(F.col("event_type"))).alias("_operation"),
        F.when(spoil == 8, "c").alias("s"),
    )
    return events.select("event_id", "user_id", F.to_json(document).alias("value"))

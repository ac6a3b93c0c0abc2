"""What kinds of values text columns hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import is_date
from ..functions.text import is_blank

KINDS = ("DATETIME", "LONG", "DOUBLE", "STRING")


def guess_type(c: Column) -> Column:
    """DATETIME, LONG, DOUBLE or STRING, tried in this order; blank is STRING."""
    digits = c.rlike(r"^\p{Nd}+$")
    number = F.translate(c, ".,", "").rlike(r"^\p{Nd}+$")
    return (
        F.when(is_blank(c), "STRING")
        .when(is_date(c), "DATETIME")
        .when(digits, "LONG")
        .when(number, "DOUBLE")
        .otherwise("STRING")
    )


def profile_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the number of values of each kind, from one pass over the rows."""
    guesses = df.select(*[guess_type(F.col(c).cast("string")).alias(c) for c in columns])
    counted = guesses.agg(
        *[F.count_if(F.col(c) == kind).alias(f"{c}#{kind}") for c in columns for kind in KINDS]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"), *[F.col(f"`{c}#{kind}`").alias(f"n_{kind.lower()}") for kind in KINDS]
        )
        for c in columns
    ]
    return counted.select(F.inline(F.array(*rows)))


def json_fields(df: DataFrame, column: str) -> DataFrame:
    """`rows, valid, merged`: how many texts there are, how many parse as JSON, and the one type that holds all
    of them. A text is parsed once, to Variant; types meet by partial aggregates, so a field that is a number
    in some rows and text in others shows as what holds both."""
    parsed = df.select(F.col(column).isNotNull().alias("there"), F.try_parse_json(column).alias("v"))
    return parsed.agg(
        F.count_if("there").alias("rows"), F.count_if(F.col("v").isNotNull()).alias("valid"), F.schema_of_variant_agg("v").alias("merged")
    )


def profile_json_fields(df: DataFrame, column: str, paths: Sequence[str]) -> DataFrame:
    """For each path (as `$.a.b`) of the JSON texts of a column: `path`, in how many rows it is `present`
    (JSON null counts), and how many values are `n_integer`, `n_number`, `n_text` and `n_boolean`, from one
    parse of a row."""
    # Behind a generator, so that the texts are parsed once and not for each path.
    parsed = df.select(F.explode(F.array(F.try_parse_json(column))).alias("v"))
    kinds = {f"k{i}": F.schema_of_variant(F.try_variant_get("v", path, "variant")) for i, path in enumerate(paths)}
    typed = parsed.select(*[kind.alias(name) for name, kind in kinds.items()])
    rules = {
        "present": lambda k: k.isNotNull(),
        "n_integer": lambda k: k == "BIGINT",
        "n_number": lambda k: k.rlike("^(DECIMAL|DOUBLE|FLOAT)"),
        "n_text": lambda k: k == "STRING",
        "n_boolean": lambda k: k == "BOOLEAN",
    }
    counted = typed.agg(*[F.count_if(rule(F.col(name))).alias(f"{name}#{what}") for name in kinds for what, rule in rules.items()])
    rows = [
        F.struct(F.lit(path).alias("path"), *[F.col(f"`{name}#{what}`").alias(what) for what in rules]) for name, path in zip(kinds, paths)
    ]
    return counted.select(F.inline(F.array(*rows)))

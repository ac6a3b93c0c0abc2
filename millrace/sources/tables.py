"""Tables of the catalog: description, creation, partitions, and rows made to fit them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.convert import exact_integer
from ..operators.lookup import missing_partitions
from .files import leaf_partitions, unescape

FORMATS = ("parquet", "orc", "text")
DEFAULT_DELIMITER = "\x01"


@dataclass(frozen=True)
class TableInfo:
    name: str
    columns: tuple[tuple[str, str], ...]
    partition_columns: tuple[str, ...]
    format: str
    delimiter: str
    location: str

    @property
    def data_columns(self) -> tuple[tuple[str, str], ...]:
        return tuple(c for c in self.columns if c[0] not in self.partition_columns)


def storage_format(provider: str, serde: str = "") -> str:
    """Parquet and ORC by name, all else is text; formats that cannot be written are refused."""
    named = f"{provider} {serde}".lower()
    for fmt in ("parquet", "orc"):
        if fmt in named:
            return fmt
    if "avro" in named or "rcfile" in named:
        raise ValueError(f"storage format [{provider or serde}] is not supported, only {FORMATS}")
    return "text"


def describe_table(spark: SparkSession, table: str) -> TableInfo:
    columns = spark.catalog.listColumns(table)
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    detail = {r["col_name"]: r["data_type"] for r in rows}
    properties = " ".join(detail.get(k, "") or "" for k in ("Storage Properties", "Table Properties"))
    delimiter = DEFAULT_DELIMITER
    for name in ("field.delim", "delimiter", "sep"):
        _, found, rest = properties.partition(f"{name}=")
        if found and rest:
            # A comma or bracket also ends a property, so the delimiter's first character is taken as it is.
            tail = re.match(r"(.[^,\]]*)", rest, re.S).group(1)
            delimiter = tail.encode("latin-1", "backslashreplace").decode("unicode_escape") if "\\" in tail else tail
            break
    return TableInfo(
        name=table,
        columns=tuple((c.name, c.dataType) for c in columns),
        partition_columns=tuple(c.name for c in columns if c.isPartition),
        format=storage_format(detail.get("Provider", "") or "", detail.get("Serde Library", "") or ""),
        delimiter=delimiter,
        location=detail.get("Location", ""),
    )


def ensure_table(
    spark: SparkSession,
    table: str,
    columns: str,
    partition_columns: Sequence[str] = (),
    fmt: str = "parquet",
    location: str | None = None,
    **options: str,
) -> None:
    """Create the table unless it exists. `columns` is a DDL list."""
    parts = f" PARTITIONED BY ({', '.join(partition_columns)})" if partition_columns else ""
    given = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}"
        f"{f' OPTIONS ({given})' if given else ''}{parts}{place}"
    )


def truncate_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def registered_partitions(spark: SparkSession, info: TableInfo) -> DataFrame:
    shown = spark.sql(f"SHOW PARTITIONS {info.name}")
    text = F.concat(F.lit("/"), F.col("partition"))
    values = [F.regexp_extract(text, rf"/{k}=([^/]*)", 1) for k in info.partition_columns]
    return shown.select(
        *[
            F.when(v.isin("__HIVE_DEFAULT_PARTITION__", "null"), None).otherwise(unescape(v)).alias(k)
            for v, k in zip(values, info.partition_columns)
        ]
    )


def matching_partitions(spark: SparkSession, table: str, values: dict[str, object]) -> DataFrame:
    """The registered partitions of a table that have the given values, one row each."""
    info = describe_table(spark, table)
    unknown = set(values) - set(info.partition_columns)
    if unknown:
        raise ValueError(f"not partition columns of {table}: {sorted(unknown)}")
    found = registered_partitions(spark, info)
    for key, value in values.items():
        found = found.where(F.col(key).eqNullSafe(F.lit(value).cast("string")))
    return found


def add_partitions(spark: SparkSession, table: str, batch: int = 200) -> int:
    """Register partition directories that the catalog does not know yet; how many."""
    info = describe_table(spark, table)
    keys = info.partition_columns
    if not keys:
        return 0
    found = leaf_partitions(spark, info.location, keys)
    new = missing_partitions(found, registered_partitions(spark, info), keys)

    def clause(row) -> str:
        def literal(key: str) -> str:
            if row[key] is None:
                return "NULL"
            quoted = row[key].replace("\\", "\\\\").replace("'", "\\'")
            return f"'{quoted}'"

        return "PARTITION (" + ", ".join(f"`{k}` = {literal(k)}" for k in keys) + ")"

    clauses = (clause(row) for row in new.toLocalIterator())
    added = 0
    while some := list(islice(clauses, batch)):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(some)}")
        added += len(some)
    return added


def refresh_partitions(spark: SparkSession, table: str) -> None:
    """Register whatever directories there are, and forget cached file lists."""
    spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)


# What the integer types hold.
INTEGER_BOUNDS = {
    "tinyint": (-(1 << 7), (1 << 7) - 1),
    "smallint": (-(1 << 15), (1 << 15) - 1),
    "int": (-(1 << 31), (1 << 31) - 1),
    "bigint": (-(1 << 63), (1 << 63) - 1),
}


def fit(c: Column, source: T.DataType, target: str | T.DataType) -> Column:
    """A value as a column type; what does not fit becomes null."""
    name = target if isinstance(target, str) else target.simpleString()
    name = name.lower()
    if name == "binary":
        return F.encode(c.cast("string"), "UTF-8") if not isinstance(source, T.BinaryType) else c
    if name.startswith(("varchar", "char")):
        # A value longer than the type promises does not fit.
        length = int(re.search(r"\d+", name).group())
        text = c.cast("string")
        return F.when(F.char_length(text) <= length, text)
    if isinstance(source, T.StringType) and name.startswith(("array", "map", "struct")):
        return F.from_json(c, name)
    if isinstance(source, (T.ArrayType, T.MapType, T.StructType)) and name == "string":
        return F.to_json(c)
    if name in INTEGER_BOUNDS and isinstance(source, T.StringType):
        return exact_integer(c, name)
    if name in INTEGER_BOUNDS and isinstance(source, (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)):
        low, high = INTEGER_BOUNDS[name]
        # Cut toward zero, so anything short of the next integer still fits.
        inside = (c > low - 1) & (c < high + 1) if name != "bigint" else (c >= float(low)) & (c < float(high))
        whole = isinstance(source, T.LongType) and name == "bigint"
        return c if whole else F.when(inside, c.cast(name))
    return c.try_cast(name)


def conform(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows with exactly the table's columns, by name and type; absent ones are null."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (fit(F.col(n), have[n], t) if n in have else F.lit(None).cast(t)).alias(n)
            for n, t in columns
        ]
    )

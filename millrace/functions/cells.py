"""Cell bytes: texts as UTF-8, longs, instants and doubles as 8 big-endian bytes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CELL_FAMILY = "objects"


def long_bytes(c: Column) -> Column:
    return F.unhex(F.lpad(F.hex(c.cast("bigint")), 16, "0"))


def double_bytes(c: Column) -> Column:
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), c)
    return F.when(c.isNotNull(), long_bytes(bits.cast("bigint")))


def bytes_long(b: Column) -> Column:
    return F.conv(F.hex(b), 16, -10).cast("bigint")


def bytes_double(b: Column) -> Column:
    value = F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bytes_long(b))
    return F.when(b.isNotNull(), value.cast("double"))


def encode(c: Column, declared: str) -> Column:
    """Bytes of one value by its declared type; arrays are kept as JSON text."""
    declared = declared.upper()
    if declared == "LONG":
        return long_bytes(c)
    if declared == "DOUBLE":
        return double_bytes(c.cast("double"))
    if declared == "DATETIME":
        return long_bytes(F.unix_millis(c.cast("timestamp")))
    if declared == "ARRAY":
        return F.encode(F.to_json(c), "UTF-8")
    return F.encode(c.cast("string"), "UTF-8")


def decode(b: Column, declared: str) -> Column:
    declared = declared.upper()
    if declared == "LONG":
        return bytes_long(b)
    if declared == "DOUBLE":
        return bytes_double(b)
    if declared == "DATETIME":
        return F.timestamp_millis(bytes_long(b))
    text = F.decode(b, "UTF-8")
    return F.from_json(text, "array<string>") if declared == "ARRAY" else text

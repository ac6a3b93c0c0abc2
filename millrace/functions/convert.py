"""Text to typed value. Each conversion gives null where the text does not fit the type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

LONG_MAX = 9223372036854775807
INTEGER = r"^\s*[+-]?[0-9]{1,19}\s*$"
# The only non-finite spellings Java reads as a double.
NON_FINITE_WORDS = ("NaN", "+NaN", "-NaN", "Infinity", "+Infinity", "-Infinity")


def to_string(c: Column) -> Column:
    return c.cast("string")


def to_double(c: Column) -> Column:
    """A double in Java's spelling; other spellings of infinity and NaN are refused."""
    # `n` occurs in no finite number, so only such words pay for the spelling test.
    return F.when(~c.rlike("[nN]") | F.trim(c).isin(*NON_FINITE_WORDS), c.try_cast("double"))


def exact_integer(c: Column, target: str = "bigint") -> Column:
    """The value of a text that is an integer. Others are told by their look, since a
    cast that fails costs many times one that does not."""
    return F.when(c.rlike(INTEGER), c.try_cast(target))


def to_long(c: Column) -> Column:
    """The number cut toward zero, integers exactly.

    Out-of-range values take the nearest bound and NaN gives 0, as `floor` and `ceil` do.
    """
    number = to_double(c)
    return F.coalesce(exact_integer(c), F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)))


def to_boolean(c: Column) -> Column:
    return F.lower(c) == "true"


def to_array(c: Column) -> Column:
    """A JSON array as texts; elements that are not strings keep their JSON text."""
    return F.from_json(c, T.ArrayType(T.StringType()))


def normalise_number(c: Column) -> Column:
    """A JSON number as `struct<as_long, as_double>` with one of the two set.

    Whole values become longs, others and those above the long range doubles.
    """
    number = to_double(c)
    fits = (number == F.rint(number)) & (F.abs(number) < float(LONG_MAX))
    whole = F.coalesce(exact_integer(c), F.when(fits, F.floor(number)))
    return F.struct(whole.alias("as_long"), F.when(whole.isNull(), number).alias("as_double"))


# Declared type -> Spark type of the converted column. Other declared types keep the JSON text.
SPARK_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "LONG": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "ARRAY": T.ArrayType(T.StringType()),
}
_CONVERT = {
    "STRING": to_string,
    "DOUBLE": to_double,
    "LONG": to_long,
    "BOOLEAN": to_boolean,
    "ARRAY": to_array,
}


def convert(c: Column, declared: str) -> Column:
    return _CONVERT.get(declared.upper(), to_string)(c)


def conversion_failed(raw: Column, declared: str) -> Column:
    """True where a present value does not fit its declared numeric type."""
    if declared.upper() == "DOUBLE":
        return raw.isNotNull() & to_double(raw).isNull()
    if declared.upper() == "LONG":
        return raw.isNotNull() & to_double(raw).isNull() & (raw != "null")
    return F.lit(False)

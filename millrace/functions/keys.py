"""Row keys, salts and region boundaries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LOGIC_PARTITIONS = 1000
HASH_DIGITS = 3
_TWO_32 = 1 << 32


def _code_units(c: Column) -> Column:
    """UTF-16 code units of a text: characters beyond the first plane count as two."""
    points = F.transform(F.split(c, ""), lambda ch: F.ascii(ch).cast("bigint"))
    units = F.flatten(
        F.transform(
            points,
            lambda p: F.when(
                p > 0xFFFF,
                F.array(F.lit(0xD800) + run_of(p - 0x10000, 1024), F.lit(0xDC00) + (p - 0x10000) % 1024),
            ).otherwise(F.array(p)),
        )
    )
    return F.when(F.octet_length(c) == F.length(c), points).otherwise(units)


def _unsigned_hash(c: Column) -> Column:
    return F.aggregate(_code_units(c), F.lit(0).cast("bigint"), lambda acc, unit: (acc * 31 + unit) % _TWO_32)


def string_hash(c: Column) -> Column:
    """The 32-bit polynomial (base 31) text hash, as a signed bigint."""
    half = _TWO_32 // 2
    return F.pmod(_unsigned_hash(c) + half, F.lit(_TWO_32)) - half


def partition_hash(c: Column, logic_partitions: int = LOGIC_PARTITIONS) -> Column:
    """The leading digits of a row key: the size of the hash modulo the logic partitions.

    The smallest 32-bit hash has no positive counterpart; as an unsigned 64-bit number
    it is 2^64 - 2^31, whose remainder is worked out here.
    """
    half = _TWO_32 // 2
    odd_one = ((1 << 64) - half) % logic_partitions
    size = half - F.abs(_unsigned_hash(c) - half)
    # A one-element transform binds the hash, so that it is worked out once per row.
    remainder = F.transform(F.array(size), lambda h: F.when(h == half, odd_one).otherwise(h % logic_partitions))
    digits = remainder.getItem(0).cast("string")
    width = max(HASH_DIGITS, len(str(logic_partitions - 1)))
    return F.lpad(digits, width, "0") if width == HASH_DIGITS else F.lpad(
        digits, F.greatest(F.length(digits), F.lit(HASH_DIGITS)), F.lit("0")
    )


def row_key(c: Column, logic_partitions: int = LOGIC_PARTITIONS) -> Column:
    """`<3 digits>#<key>`: neighbouring keys land in different regions."""
    return F.concat(partition_hash(c, logic_partitions), F.lit("#"), c)


def split_points(n_logic: int = LOGIC_PARTITIONS, n_physical: int = 16) -> list[str]:
    """Region boundaries: the last logic partition of every region but the last."""
    if n_logic <= 0 or n_physical <= 0:
        raise ValueError("partition counts must be positive")
    width = n_logic // n_physical
    if width == 0:
        raise ValueError("more physical than logic partitions")
    ends = [f"{start - 1:03d}" for start in range(width, n_logic, width)]
    return ends[:-1] if len(ends) == n_physical else ends


def region_of(key: Column, n_logic: int = LOGIC_PARTITIONS, n_physical: int = 16) -> Column:
    """Number of the region that holds a row key, from 0."""
    bounds = F.array(*[F.lit(b) for b in split_points(n_logic, n_physical)])
    # A one-element transform binds the key, so that it is worked out once per row.
    return F.transform(F.array(key), lambda k: F.size(F.filter(bounds, lambda b: b <= k))).getItem(0)


def run_of(c: Column, n: int) -> Column:
    """Which run of `n` a whole number from 0 falls into, without going through doubles."""
    return F.call_function("div", c, F.lit(n))


def stable_salt(key: Column, n: int) -> Column:
    """A repeatable salt in 0..n-1."""
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

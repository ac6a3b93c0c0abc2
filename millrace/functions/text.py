"""Small text predicates shared by the checks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Java counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a"
    "\u2028\u2029\u205f\u3000"
)


_VISIBLE = "[^" + "".join(f"\\x{{{ord(ch):x}}}" for ch in WHITE_SPACE) + "]"


def is_blank(c: Column) -> Column:
    """Null, empty or white space only; never null itself."""
    # The search ends at the first character that is not white space.
    return ~F.coalesce(c.rlike(_VISIBLE), F.lit(False))


def has_slash(c: Column) -> Column:
    return F.coalesce(c.contains("/"), F.lit(False))

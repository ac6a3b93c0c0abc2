"""Date texts in the accepted spellings, as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"
LOCAL_PATTERN = "yyyy-MM-dd HH:mm:ss"
_DAY = "[0-9]{4}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])"


def parse_date(c: Column) -> Column:
    """A timestamp from `yyyyMMdd` or `yyyyMMddHHmmss` once dash, bar, colon and blank
    are removed, or from an ISO text ending in Z, which is UTC.

    Local texts are in the session's zone. Other texts give null.
    """
    bare = F.translate(c, "-|: ", "")
    # Told by length and look first, since a failed parse costs many times one that succeeds.
    size = F.length(bare)
    local = F.when((size == 8) & bare.rlike(f"^{_DAY}$"), F.try_to_timestamp(bare, F.lit("yyyyMMdd"))).when(
        (size == 14) & bare.rlike(f"^{_DAY}[0-9]{{6}}$"), F.try_to_timestamp(bare, F.lit("yyyyMMddHHmmss"))
    )
    iso = F.when(c.endswith("Z"), F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssX")))
    return F.when(c.contains("T"), iso).otherwise(local)


def is_date(c: Column) -> Column:
    """Whether a text is in one of the accepted spellings."""
    plausible = c.rlike("^[-|: 0-9]{8,}$|T")
    return F.coalesce(plausible & parse_date(c).isNotNull(), F.lit(False))


def format_local(ts: Column, pattern: str = LOCAL_PATTERN) -> Column:
    return F.date_format(ts, pattern)


def format_utc(ts: Column) -> Column:
    """The instant as an ISO text in UTC."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))
    return F.date_format(utc, ISO_PATTERN)


def shift(ts: Column, years: int = 0, days: int = 0, hours: int = 0) -> Column:
    """Move by calendar years, days and hours; negative values go back."""
    return ts + F.make_interval(years=F.lit(years), days=F.lit(days), hours=F.lit(hours))


def start_of_day(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def end_of_day(ts: Column) -> Column:
    """The last millisecond of the day."""
    return F.date_trunc("day", ts) + F.expr("interval 1 day") - F.expr("interval 1 millisecond")

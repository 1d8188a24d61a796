"""Column functions for dates and instants held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INSTANT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?\s*([Zz]|[+-]\d{2}:?\d{2})?)?$"
_ZONED = r"([Zz]|[T ]\d{2}:\d{2}[^+-]*[+-]\d{2}:?\d{2})$"


def instant(column: Column | str) -> Column:
    """The text as a timestamp, or null where it is not an instant and nothing else.

    Date and time may be parted by ``T`` or a space; a value without a zone is UTC,
    whatever the session's zone is.
    """
    c = F.trim(F.col(column) if isinstance(column, str) else column)
    zoned = F.when(F.length(c) == 10, F.concat(c, F.lit("T00:00:00Z"))).when(c.rlike(_ZONED), F.upper(c)).otherwise(F.concat(c, F.lit("Z")))
    zoned = F.regexp_replace(zoned, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(c.rlike(_INSTANT), F.regexp_replace(zoned, r"\s+(?=[Z+-])", "").try_cast("timestamp"))


def first_date(column: Column | str) -> Column:
    """The date in the first ten characters, or null."""
    c = F.col(column) if isinstance(column, str) else column
    head = F.substring(c, 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date"))


def event_year(column: Column | str, default: Column | int) -> Column:
    """The year in the first four characters if they are digits, else ``default``."""
    c = F.col(column) if isinstance(column, str) else column
    head = F.substring(c, 1, 4)
    other = F.lit(default) if isinstance(default, int) else default
    return F.when(head.rlike(r"^\d{4}$"), head.try_cast("int")).otherwise(other.cast("int"))


def month_chunks(start: Column, end: Column) -> Column:
    """Array of inclusive (after, before) spans: to the end of the first month, whole months, then clipped."""
    months = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))
    spans = F.transform(months, lambda m: F.struct(F.greatest(start, m.cast("date")).alias("after"), F.least(end, F.last_day(m)).alias("before")))
    return F.when(start <= end, spans).otherwise(F.array().cast("array<struct<after:date,before:date>>"))


def week_chunks(start: Column, end: Column) -> Column:
    """Array of adjoining inclusive spans of seven days, the last one clipped."""
    days = F.sequence(start, end, F.expr("interval 7 days"))
    spans = F.transform(days, lambda d: F.struct(d.cast("date").alias("after"), F.least(F.date_add(d.cast("date"), 6), end).alias("before")))
    return F.when(start <= end, spans).otherwise(F.array().cast("array<struct<after:date,before:date>>"))


def daily_window(now: Column, zone: str, days: int) -> Column:
    """(after, before) of a rolling window that ends yesterday in ``zone``."""
    before = F.date_sub(F.to_date(F.from_utc_timestamp(now, zone)), 1)
    return F.struct(F.date_sub(before, days - 1).alias("after"), before.alias("before"))


def rfc822_date(column: Column | str) -> Column:
    """ISO date text of a mail-style date such as ``Tue, 02 Jan 2024 10:00:00 GMT``, else the first ten characters."""
    c = F.col(column) if isinstance(column, str) else column
    body = F.regexp_extract(c, r"(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2})", 1)
    parsed = F.try_to_timestamp(body, F.lit("d MMM yyyy HH:mm:ss"))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.substring(c, 1, 10))


def relative_age(column: Column | str, today: Column) -> Column:
    """Date of an English age such as ``3 days ago``; a month has 30 days and a year 365."""
    c = F.lower(F.col(column) if isinstance(column, str) else column)
    n = F.regexp_extract(c, r"(\d+)\s*(minute|hour|day|week|month|year)", 1).try_cast("int")
    unit = F.regexp_extract(c, r"(\d+)\s*(minute|hour|day|week|month|year)", 2)
    days = F.when(unit == "week", n * 7).when(unit == "month", n * 30).when(unit == "year", n * 365).when(unit == "day", n).otherwise(F.lit(0))
    return F.when(n.isNotNull(), F.date_sub(today, days))


def is_stale(started: Column, ttl_seconds: Column, now: Column) -> Column:
    """Whether ``now`` lies beyond ``started`` plus its time to live; an unreadable start is stale."""
    return F.coalesce(now > instant(started) + F.make_dt_interval(secs=ttl_seconds.cast("double")), F.lit(True))

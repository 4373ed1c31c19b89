"""Date and time functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000

# The date formats read from text besides ISO forms, in the order they are tried, and what a text in them
# looks like. A text that does not fit a format costs an exception, so it is tried only on texts that look like it.
_DAY, _MONTH = "(0[1-9]|[12][0-9]|3[01])", "(0[1-9]|1[0-2])"
DATE_FORMATS = {"MM/dd/yyyy": f"^{_MONTH}/{_DAY}/[0-9+-]", "dd/MM/yyyy": f"^{_DAY}/{_MONTH}/[0-9+-]"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a date or time."""
    return F.unix_micros(_col(c).cast("timestamp"))


def to_ts(c: Column | str, fmt: str | None = None) -> Column:
    """Text to timestamp; NULL where the text does not fit."""
    c = _col(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else c.try_cast("timestamp")


def parse_any_date(c: Column | str) -> Column:
    """Text in any form Spark reads (ISO dates and times), else in one of the known formats; blank and NA are missing."""
    text = F.trim(_col(c))
    usable = F.when((text != "") & (text != "NA"), text)
    return F.coalesce(to_ts(usable), *[F.when(usable.rlike(look), to_ts(usable, fmt)) for fmt, look in DATE_FORMATS.items()])


def plus_days(c: Column | str, n: int | Column) -> Column:
    """``n`` whole days later (earlier when negative).

    Times carry no zone and sessions run in UTC, so a day is always 24 hours: plain arithmetic on
    microseconds, which Spark evaluates far faster than calendar intervals.
    """
    days = F.lit(n).cast("long") if isinstance(n, int) else n.cast("int").cast("long")
    return F.timestamp_micros(micros(c) + days * F.lit(DAY_MICROS))


def plus_hours(c: Column | str, n: Column) -> Column:
    return F.timestamp_micros(micros(c) + n.cast("long") * F.lit(DAY_MICROS // 24))


def plus_fractional_days(c: Column | str, n: Column) -> Column:
    return F.timestamp_micros(micros(c) + (n * DAY_MICROS).cast("long"))


def days_between(a: Column | str, b: Column | str) -> Column:
    """Whole days from ``b`` to ``a``, rounded down: one hour early is -1."""
    gap = micros(a) - micros(b)
    return ((gap - F.pmod(gap, F.lit(DAY_MICROS))) / F.lit(DAY_MICROS)).cast("long")


def as_timestamp(moment) -> Column:
    """A literal clock reading: a Column, a datetime or ISO text."""
    if isinstance(moment, Column):
        return moment
    return F.lit(moment).cast("timestamp")

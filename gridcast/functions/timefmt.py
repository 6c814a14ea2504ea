"""Time expressions.

All parsing is lenient (``try_to_timestamp``): a bad value becomes NULL and the
row is routed to quarantine by the caller instead of failing the whole job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats the data sets use.
HOURLY_FORMAT = "yyyy-MM-dd'T'HH:mm"  # weather arrays
PRICE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"  # price records, live readings
DAY_FORMAT = "yyyy-MM-dd"
MONTH_TAG_FORMAT = "yyyy_MM"
AXIS_HOUR_FORMAT = "HH:mm"
AXIS_DAY_FORMAT = "EEE dd"

MICROS_PER_SECOND = 1_000_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_time(value: str | dt.datetime | Column) -> Column:
    """A time given as a column, a Python datetime or ISO text."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        return F.lit(value).cast("timestamp")
    return F.to_timestamp(F.lit(value))


def parse_time(c: str | Column, fmt: str | None = None) -> Column:
    """Text to TIMESTAMP; NULL when it does not parse."""
    if fmt is None:
        return F.try_to_timestamp(_col(c))
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def hour_bucket(c: str | Column) -> Column:
    """Truncate to the hour (a TIMESTAMP, also for TIMESTAMP_NTZ input)."""
    return F.date_trunc("hour", _col(c))


def hour_of_day(c: str | Column) -> Column:
    """0-23."""
    return F.hour(_col(c)).cast("int")


def day_of_week(c: str | Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_col(c)).cast("int")


def plus_minutes(c: str | Column, minutes: str | Column) -> Column:
    """Time + a whole number of minutes."""
    return _col(c) + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), _col(minutes), F.lit(0))


def micros(c: str | Column) -> Column:
    return F.unix_micros(_col(c).cast("timestamp"))


def micros_between(a: str | Column, b: str | Column) -> Column:
    """X11 in whole microseconds (exact, for strict bounds): a - b."""
    return micros(a) - micros(b)


def seconds_between(a: str | Column, b: str | Column) -> Column:
    """X11: signed seconds a - b, as a double."""
    return micros_between(a, b) / F.lit(float(MICROS_PER_SECOND))


def iso_text(c: str | Column, fmt: str = PRICE_FORMAT) -> Column:
    """Time to text."""
    return F.date_format(_col(c), fmt)


def epoch_seconds(c: str | Column) -> Column:
    """A time as epoch seconds (double), like a fetch stamp."""
    return micros(c) / F.lit(float(MICROS_PER_SECOND))


def month_starts(start: str | Column, end: str | Column) -> Column:
    """First day of every month from the month of ``start`` to ``end``."""
    first = F.trunc(_col(start).cast("date"), "month")
    return F.sequence(first, _col(end).cast("date"), F.expr("interval 1 month"))

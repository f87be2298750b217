"""Time expressions. All timestamps are TIMESTAMP_NTZ, so none of these depends
on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000

# Fixed value: orders and events carry the local time of this zone.
DATA_ZONE = "Asia/Kolkata"


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Exact microseconds from `start` to `end`; NULL if either is NULL.

    By interval rather than `timestamp_diff`, which reads zone-less times in
    the session zone and moves those that a daylight-saving change skips.
    """
    seconds = (_col(end) - _col(start)).cast("interval second").cast("decimal(18,6)")
    return (seconds * F.lit(1_000_000)).cast("bigint")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Fractional minutes from `start` to `end`."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_MINUTE))


def mean_minutes(start: Column | str, end: Column | str, weight: Column | None = None) -> Column:
    """Aggregate: mean minutes from `start` to `end`, from an exact sum of microseconds.

    Sums of doubles depend on the order of their tasks in the last digits.
    `weight` replaces the microseconds that are summed.
    """
    micros = micros_between(start, end)
    total = F.sum((micros if weight is None else weight).cast("decimal(38,0)")).cast("double")
    return total / F.count(micros) / F.lit(float(MICROS_PER_MINUTE))


def time_slot(hour: Column | str) -> Column:
    """Part of the day for an hour; hours outside 8-23 and NULL are late_night."""
    hour = _col(hour)
    return (
        F.when(hour.between(8, 11), "morning")
        .when(hour.between(12, 15), "lunch")
        .when(hour.between(16, 19), "evening")
        .when(hour.between(20, 23), "dinner")
        .otherwise("late_night")
    )


def week_start(day: Column | str) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(_col(day).cast("date"), "week")


def week_end(monday: Column | str) -> Column:
    """Sunday of the week at midnight, as a timestamp."""
    return F.date_add(_col(monday), 6).cast("timestamp_ntz")


def month_start(day: Column | str) -> Column:
    return F.trunc(_col(day).cast("date"), "month")


def day_name(day: Column | str) -> Column:
    return F.date_format(_col(day), "EEEE")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from date `start` to date `end`."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def now_in(zone: str) -> Column:
    """The clock in `zone` as a zone-less timestamp, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), F.localtimestamp())


def as_of_date(as_of: dt.date | None, zone: str = DATA_ZONE) -> Column:
    return now_in(zone).cast("date") if as_of is None else F.lit(as_of)


def as_of_timestamp(as_of: dt.datetime | None, zone: str = DATA_ZONE) -> Column:
    if as_of is None:
        return now_in(zone)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value

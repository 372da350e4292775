"""Date and time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
# Text forms of times.
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def iso_timestamp(value: Column) -> Column:
    """ISO text to a timestamp; a zone suffix is not looked at, malformed text gives null."""
    return F.try_to_timestamp(F.substring(value, 1, 19), F.lit(ISO_FORMAT))


def iso_millis(value: Column) -> Column:
    return F.unix_millis(iso_timestamp(value))


def second_text(ts: Column) -> Column:
    return F.date_format(ts, SECOND_FORMAT)


def parse_second_text(value: Column) -> Column:
    return F.try_to_timestamp(value, F.lit(SECOND_FORMAT))


def add_minutes(ts: Column, minutes: int) -> Column:
    return ts + F.make_dt_interval(mins=F.lit(minutes))


def previous_day_text(ts: Column) -> Column:
    return F.date_format(F.date_sub(ts.cast("date"), 1), "yyyy-MM-dd")


def day_start_text(ts: Column) -> Column:
    return F.date_format(F.date_trunc("day", ts), SECOND_FORMAT)


def millis_between(start: Column, end: Column) -> Column:
    return F.unix_millis(end) - F.unix_millis(start)


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end, toward zero; -1 when either is missing."""
    ms = millis_between(start, end)
    return F.coalesce((ms - ms % F.lit(DAY_MS)) / F.lit(DAY_MS), F.lit(-1)).cast("int")


def is_expired(start: Column, end: Column, days: int = 30) -> Column:
    """More than ``days`` whole days have passed."""
    return days_between(start, end) > days

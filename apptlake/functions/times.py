"""Dates and times. External text is parsed with the ``try_`` forms: bad text becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats and the weekday order of reports.
SPEND_DAY_FORMAT = "yyyy-MM-dd"
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
WEEKDAY_FORMAT = "EEEE"
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def instant(text: Column) -> Column:
    """ISO text to timestamp, honouring an offset in the text."""
    return text.try_cast("timestamp")


def written_day(text: Column) -> Column:
    """The day as written at the head of ISO text, whatever offset follows."""
    return text.try_cast("date")


def spend_day(text: Column) -> Column:
    return F.try_to_date(text, SPEND_DAY_FORMAT)


def tolerant_day(value: Column) -> Column:
    """Day of a text, date or timestamp value; null if it is none."""
    return value.try_cast("timestamp").cast("date")


def week_start(value: Column) -> Column:
    """Monday of the value's week, as a date."""
    return F.trunc(F.to_date(value), "week")


def weekday_name(day: Column) -> Column:
    return F.date_format(day, WEEKDAY_FORMAT)


def clock_stamp() -> Column:
    return F.date_format(F.current_timestamp(), STAMP_FORMAT)

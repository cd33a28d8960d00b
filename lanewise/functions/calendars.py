"""Calendar features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday0(date: Column) -> Column:
    """Weekday with Sunday = 0 and Saturday = 6."""
    return F.dayofweek(date) - 1


def days_between(end: Column, start: Column) -> Column:
    """Whole calendar days from `start` to `end`; the time of day plays no part."""
    return F.datediff(end, start)


def parse_mdy(text: Column, pivot: int = 69) -> Column:
    """Date of text such as '7/4/23', null when it is no date.

    Two-digit years from `pivot` on are of the last century.
    """
    date = F.try_to_timestamp(text, F.lit("M/d/yy")).cast("date")
    return F.when(F.year(date) >= 2000 + pivot, F.add_months(date, -1200)).otherwise(date)


def holiday_label(holiday: Column, note: Column) -> Column:
    """Label of a day by its holiday row; a note marks the day before and wins over the name."""
    return F.when(note.isNotNull(), "before_holiday").when(holiday.isNotNull(), "holiday").otherwise("regular")

"""Calendar parts of dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The text layout of a GPS timestamp.
DAY_CHARS = 10
SECOND_CHARS = 19


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def leading_day(text: Column) -> Column:
    """The day part of a timestamp given as text."""
    return F.substring(text, 1, DAY_CHARS)


def leading_second(text: Column) -> Column:
    """The timestamp at the start of a text, whole seconds; null if there is none."""
    return F.try_to_timestamp(F.substring(text, 1, SECOND_CHARS))

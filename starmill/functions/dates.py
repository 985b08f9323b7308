"""Decoding of dates and times, and their calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.functions.columns import as_column

# SAS counts days from this date.
SAS_EPOCH = "1960-01-01"

# The three weekday numberings in use: Sunday = 1, Sunday = 0, Monday = 0.
WEEKDAYS = {
    "sun1": F.dayofweek,
    "sun0": lambda c: F.dayofweek(c) - F.lit(1),
    "mon0": F.weekday,
}


def epoch_millis(c: Column | str) -> Column:
    """Epoch milliseconds to a timestamp that keeps the milliseconds."""
    return F.timestamp_millis(as_column(c).cast("long"))


def epoch_seconds(c: Column | str) -> Column:
    """Epoch milliseconds to a timestamp in whole seconds.

    The division is that of whole numbers: it cuts towards zero, also before 1970.
    """
    return F.timestamp_seconds(F.call_function("div", as_column(c).cast("long"), F.lit(1000)))


def epoch_to_date(c: Column | str) -> Column:
    return F.to_date(epoch_millis(c))


def sas_day_to_date(c: Column | str) -> Column:
    """Day number since 1960-01-01 to a date; null stays null."""
    return F.date_add(F.lit(SAS_EPOCH).cast("date"), as_column(c).cast("int"))


def sas_day_to_timestamp(c: Column | str) -> Column:
    return sas_day_to_date(c).cast("timestamp")


def parse_date(c: Column | str, pattern: str) -> Column:
    """Text to date by pattern, null where the text does not follow it."""
    return F.try_to_date(as_column(c), pattern)


def parse_timestamp(c: Column | str, pattern: str | None = None) -> Column:
    return F.try_to_timestamp(as_column(c), F.lit(pattern)) if pattern else F.try_to_timestamp(as_column(c))


def calendar_parts(c: Column | str, weekday: str = "sun1") -> dict[str, Column]:
    """The columns of a time dimension for timestamp ``c`` (ISO weeks)."""
    c = as_column(c)
    return {
        "hour": F.hour(c),
        "day": F.dayofmonth(c),
        "week": F.weekofyear(c),
        "month": F.month(c),
        "year": F.year(c),
        "weekday": WEEKDAYS[weekday](c).cast("int"),
    }

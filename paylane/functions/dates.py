"""Dates, windows and durations. Timestamps carry no zone, so no expression depends on the session zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: datetime) -> Column:
    return F.lit(f"{value:%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz")


def in_window(c: Column, start: datetime, end: datetime) -> Column:
    """Half-open ``[start, end)`` against literals, so the test reaches the scan."""
    return (c >= moment(start)) & (c < moment(end))


def day_text(c: Column) -> Column:
    """``YYYYMMDD``."""
    return F.replace(F.substring(c.cast("string"), 1, 10), F.lit("-"), F.lit(""))


def clock_text(c: Column) -> Column:
    """``HH:MM:SS``."""
    return F.substring(c.cast("string"), 12, 8)


def sentinel_date(text: Column) -> Column:
    """A date text for an 8-wide field: all zeros means 1 January 1900, nothing means blanks."""
    return F.rpad(F.when(text == "00000000", "19000101").otherwise(F.coalesce(text, F.lit(" "))), 8, " ")


def day_of_week_from_saturday(d: Column) -> Column:
    """Saturday is 1, Friday is 7."""
    return F.pmod(F.weekday(d) + 2, F.lit(7)) + 1


def week_of_month(d: Column) -> Column:
    """Week number that goes with ``day_of_week_from_saturday``, one day less when the month opens on a Sunday."""
    opens_on_sunday = F.when(F.weekday(F.trunc(d, "month")) == 6, 1).otherwise(0)
    days = F.dayofmonth(d) + day_of_week_from_saturday(d) - opens_on_sunday
    return F.ceil(days / F.lit(7)).cast("int")


def lag_seconds(text: Column) -> Column:
    """Seconds of an interval written ``+DD HH:MM:SS``; missing if it cannot be read."""
    return text.try_cast("interval day to second").cast("decimal(20,6)")


def duration_text(seconds: Column) -> Column:
    """``H:MM:SS``, with the days in front from 24 hours on."""
    whole = seconds.cast("bigint")
    days = F.floor(whole / 86400)
    left = F.pmod(whole, F.lit(86400))
    clock = F.format_string("%d:%02d:%02d", F.floor(left / 3600), F.floor(F.pmod(left, F.lit(3600)) / 60), F.pmod(left, F.lit(60)))
    return (
        F.when(days == 0, clock)
        .when(days == 1, F.concat(F.lit("1 day, "), clock))
        .otherwise(F.concat(days.cast("string"), F.lit(" days, "), clock))
    )

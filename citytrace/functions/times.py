"""Dates, clock text and durations.

All durations are wall-clock: they come from calendar fields and never from zoned
instants, so a daylight-saving change moves nothing whatever the session zone is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86400


def date_part(ts: Column) -> Column:
    return F.to_date(ts)


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def dow0(d: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(d) - 1


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7).cast("int")


def hour_of_text(text: Column) -> Column:
    """Hour of ``HH:mm:ss`` text; unreadable text gives NULL."""
    return F.substring(text.cast("string"), 1, 2).try_cast("int")


def ts_of_text(d: Column, text: Column) -> Column:
    """Zone-free timestamp of a date and clock text; unreadable input gives NULL."""
    return F.concat_ws(" ", d.cast("string"), text.cast("string")).try_cast("timestamp_ntz")


def month_no(d: Column) -> Column:
    return F.month(d)


def month_label(d: Column) -> Column:
    return F.date_format(d, "MMM")


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour.cast("int"))


def _elapsed(start: Column, end: Column, number: str) -> Column:
    """Seconds between two clock readings; zoned timestamps are read as the session's wall clock."""
    gap = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    return gap.cast("interval second").cast(number)


def wall_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 as the clock on the wall shows them."""
    return _elapsed(F.lit("1970-01-01"), ts, "long")


def minutes_boundary(start: Column, end: Column) -> Column:
    """Minute boundaries crossed between two timestamps."""
    minute = lambda ts: F.floor(wall_seconds(ts) / 60)
    return minute(end) - minute(start)


def minutes_exact(start: Column, end: Column) -> Column:
    """Fractional minutes, sub-second parts included."""
    return _elapsed(start, end, "decimal(18,6)").cast("double") / 60.0

"""Timestamps and dates. Everything assumes a session time zone of UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

LONDON = "Europe/London"


def moment(value: dt.datetime) -> Column:
    """A zone-free timestamp literal: the clock time as written, whatever the driver's time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day_bounds(day: dt.date | str) -> tuple[dt.datetime, dt.datetime]:
    """Start of a day and of the next one."""
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    start = dt.datetime.combine(day, dt.time())
    return start, start + dt.timedelta(days=1)


def month_bounds(year: int, month: int) -> tuple[dt.datetime, dt.datetime]:
    """Start of a month and of the next one."""
    return dt.datetime(year, month, 1), dt.datetime(year + month // 12, month % 12 + 1, 1)


def in_range(ts: Column, bounds: tuple[dt.datetime, dt.datetime]) -> Column:
    """Half-open range test on the bare column, so that it reaches file statistics."""
    return (ts >= moment(bounds[0])) & (ts < moment(bounds[1]))


def slash_date(date: Column) -> Column:
    return F.date_format(date, "yyyy/MM/dd/")


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMMM yyyy")


def compact_date(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def instant_from_millis(millis: Column) -> Column:
    """Epoch milliseconds, often as text, to an instant; absent or unreadable values give null."""
    return F.timestamp_millis(millis.try_cast("bigint"))


def london_clock(instant: Column) -> Column:
    """The wall-clock time in London of an instant."""
    return F.from_utc_timestamp(instant, LONDON)


def london_text(instant: Column) -> Column:
    """An instant as zoned London text, ``2024-07-01 13:00:00+01:00``; fractions only when present."""
    clock = london_clock(instant)
    ahead = F.unix_seconds(clock) - F.unix_seconds(instant)
    seconds = F.date_format(clock, "yyyy-MM-dd HH:mm:ss")
    fraction = F.date_format(clock, ".SSSSSS")
    return F.concat(
        seconds,
        F.when(fraction == ".000000", "").otherwise(fraction),
        F.format_string("+%02d:00", (ahead / 3600).cast("int")),
    )

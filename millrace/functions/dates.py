"""Date arithmetic by unit."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.columns import as_column

UNITS = ["microsecond", "millisecond", "second", "minute", "hour", "day", "week", "month", "quarter", "year"]
CALENDAR_UNITS = ["day", "week", "month", "quarter", "year"]


def checked_unit(unit: str) -> str:
    if unit.lower() not in UNITS:
        raise ValueError(f"unknown date part {unit!r}, expected one of {UNITS}")
    return unit.lower()


def add_units(unit: str, amount, start) -> Column:
    """``start`` plus ``amount`` units."""
    return F.timestamp_add(checked_unit(unit), as_column(amount), as_column(start))


def _second_parts(value: Column, per_second: int) -> Column:
    """Milliseconds or microseconds passed in the second ``value`` lies in."""
    return F.floor(F.date_part(F.lit("seconds"), value) * per_second) % per_second


# Units below the day: how many make the next larger one, and which of them a time lies in.
CLOCK_UNITS = {
    "hour": (24, F.hour),
    "minute": (60, F.minute),
    "second": (60, F.second),
    "millisecond": (1000, lambda value: _second_parts(value, 1000)),
    "microsecond": (1000, lambda value: _second_parts(value, 1_000_000) % 1000),
}


def _clock_units(unit: str) -> list:
    """Entries of CLOCK_UNITS from the hour down to ``unit``."""
    names = list(CLOCK_UNITS)
    return [CLOCK_UNITS[name] for name in names[: names.index(unit) + 1]]


def truncate_to(unit: str, value) -> Column:
    """Start of the unit ``value`` lies in, as a timestamp without time zone."""
    unit, moment = checked_unit(unit), as_column(value).cast("timestamp_ntz")
    day = moment.cast("date")
    if unit in CALENDAR_UNITS:
        return (day if unit == "day" else F.trunc(day, unit)).cast("timestamp_ntz")
    passed = F.lit(0).cast("long")
    for size, part in _clock_units(unit):
        passed = passed * size + part(moment)
    return F.timestamp_add(unit, passed, day.cast("timestamp_ntz"))


def count_units(unit: str, start, end) -> Column:
    """Number of unit boundaries between two times: 23:59 to 00:01 is one day. Weeks start on Sunday.

    Computed from dates and clock parts, so that no time zone's clock change has a say in it.
    """
    unit = checked_unit(unit)
    start, end = (as_column(c).cast("timestamp_ntz") for c in (start, end))
    first, last = start.cast("date"), end.cast("date")
    years = (F.year(last) - F.year(first)).cast("long")
    if unit == "year":
        return years
    if unit == "quarter":
        return years * 4 + F.quarter(last) - F.quarter(first)
    if unit == "month":
        return years * 12 + F.month(last) - F.month(first)
    if unit == "week":  # Spark's weeks start on Monday
        first, last = (F.trunc(F.date_add(c, 1), "week") for c in (first, last))
    days = F.datediff(last, first).cast("long")
    if unit == "week":
        return (days / 7).cast("long")
    count = days
    if unit != "day":
        for size, part in _clock_units(unit):
            count = count * size + part(end) - part(start)
    return count

"""Calendar expressions; wall-clock timestamps never pass through a time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# First hour after each part of the day; later hours are twilight again.
DAYPARTS = ((5, "twilight"), (10, "morning"), (15, "lunch"), (18, "afternoon"), (23, "night"))
SUNDAY, FRIDAY, SATURDAY = 1, 6, 7


def day_of(ts: Column) -> Column:
    """Start of the day as a wall-clock timestamp."""
    return F.to_date(ts).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def daypart(hour: Column) -> Column:
    part = F.when(hour < DAYPARTS[0][0], DAYPARTS[0][1])
    for limit, name in DAYPARTS[1:]:
        part = part.when(hour < limit, name)
    return part.otherwise("twilight")


def weekpart(day_of_week: Column, part: Column, mode: str = "intended") -> Column:
    """``weekend`` is Saturday, Sunday and Friday night.

    ``strict`` keeps only Friday night: it asks for a day that is Sunday and
    Saturday at once.
    """
    weekend = (day_of_week == FRIDAY) & (part == "night")
    if mode != "strict":
        weekend = weekend | day_of_week.isin(SUNDAY, SATURDAY)
    return F.when(weekend, "weekend").otherwise("weekday")


def ntz(value: dt.datetime) -> Column:
    """A wall-clock literal; comparisons with it are pushed into the Parquet scan."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def time_range(name: str, as_of: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """Bounds of a named period relative to ``as_of``."""
    month = as_of.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    if name == "last_year":
        return dt.datetime(month.year - 1, 1, 1), dt.datetime(month.year - 1, 12, 31)
    if name == "last_month":
        return (month - dt.timedelta(days=1)).replace(day=1), month
    raise ValueError(f"unknown time range {name!r}: use 'last_year' or 'last_month'")

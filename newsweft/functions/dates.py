"""Calendar rules: days, Sunday weeks, months, tolerant reading of crawl dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

#: Zone marks that crawl dates carry and that are dropped, not applied.
ZONE_MARKS = ["GMT", "-0400", "EDT", "EST", "+0000", "-0300", "-0700", "-0600", "-0500", "-0001 ", ".000"]
FORMATS = ["d MMM yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss"]


def crawl_date(text: Column, fallback: Column | None = None) -> Column:
    """Dates as feeds write them, zone marks dropped; ``fallback`` for anything unreadable."""
    for mark in ZONE_MARKS:
        text = F.replace(text, F.lit(mark), F.lit(""))
    text = F.regexp_replace(F.trim(text), "^[A-Za-z]{3}, ", "")
    tried = [F.try_to_timestamp(text, F.lit(f)) for f in FORMATS]
    return F.coalesce(*tried, fallback if fallback is not None else F.lit(None).cast("timestamp"))


def day(ts: Column) -> Column:
    return F.to_date(ts)


def week_begin(date: Column) -> Column:
    return F.date_sub(date, F.dayofweek(date) - 1)


def week_number(date: Column) -> Column:
    """Weeks of the year that begin on Sunday, 0 before the first Sunday."""
    return F.floor((F.dayofyear(date) + 7 - F.dayofweek(date)) / 7).cast("int")


def week_bound(year: int, week: int, weekday: int) -> dt.date:
    """The date of a weekday (0 = Sunday) in a Sunday week of a year."""
    first = dt.date(year, 1, 1)
    sunday = first + dt.timedelta(days=(6 - first.weekday()) % 7)
    return sunday + dt.timedelta(weeks=week - 1, days=weekday)


def month_begin(year: int, month: int) -> dt.date:
    return dt.date(year, month, 1)


def month_end(begin: dt.date) -> dt.date:
    """The first day of the next month."""
    return dt.date(begin.year + begin.month // 12, begin.month % 12 + 1, 1)


def month_id(date: Column) -> Column:
    return F.date_format(date, "yyyyMM")


def month_label(date: Column, short: bool = False) -> Column:
    return F.date_format(date, "MMM-yyyy" if short else "MMMM yyyy")


def days_back(today: dt.date, days: int = 90) -> tuple[dt.date, dt.date]:
    """The window that the daily roll-up recomputes."""
    return today - dt.timedelta(days=days), today - dt.timedelta(days=3)


def default_month(today: dt.date) -> tuple[int, int]:
    """The month that lies 25 days back."""
    at = today - dt.timedelta(days=25)
    return at.year, at.month


def epoch_millis(column: Column) -> Column:
    return F.timestamp_millis(column.cast("long"))

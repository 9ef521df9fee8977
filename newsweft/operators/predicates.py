"""Filters as Column builders; missing values follow the document-store semantics they replace."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

MAX_BODY = 20_000


def body_not_empty(body: str = "body") -> Column:
    """Everything but the empty string; null bodies stay."""
    return ~F.col(body).eqNullSafe("")


def is_annotated(field: str = "quotesUpdated") -> Column:
    return F.col(field).isNotNull()


def in_outlets(outlets: list[str], field: str = "outlet") -> Column:
    return F.col(field).isin(outlets)


def days(begin: str, end: str, field: str = "publishedAt") -> Column:
    """[begin, end + 1 day)."""
    return (F.col(field) >= F.lit(begin).cast("timestamp")) & (F.col(field) < F.lit(end).cast("timestamp") + F.expr("interval 1 day"))


def half_open(begin: str, end: str, field: str = "publishedAt") -> Column:
    """[begin, end)."""
    return (F.col(field) >= F.lit(begin).cast("timestamp")) & (F.col(field) < F.lit(end).cast("timestamp"))


def closed(begin: str, end: str, field: str = "publishedAt") -> Column:
    return F.col(field).between(F.lit(begin).cast("timestamp"), F.lit(end).cast("timestamp"))


def month(year: int, number: int, field: str = "publishedAt") -> Column:
    after = dt.date(year + number // 12, number % 12 + 1, 1)
    return half_open(f"{year:04d}-{number:02d}-01", after.isoformat(), field)


#: Conditions on counts by gender: a missing count matches none of them.
COHORTS = {"female": "{f} > 0 AND {m} = 0", "male": "{m} > 0 AND {f} = 0", "mixed": "{f} > 0 AND {m} > 0", "unknown": "{f} = 0 AND {m} = 0"}


def author_cohort(name: str, female: str = "authorsFemaleCount", male: str = "authorsMaleCount") -> Column:
    return F.expr(COHORTS[name].format(f=female, m=male))


def dominance(delta: int = 1, female: str = "sourcesFemaleCount", male: str = "sourcesMaleCount") -> Column:
    """'female' or 'male' where one count leads by ``delta``; null otherwise."""
    return F.when(F.col(female) - F.col(male) >= delta, "female").when(F.col(male) - F.col(female) >= delta, "male")


def short_enough(body: str = "body") -> Column:
    return F.length(body) <= MAX_BODY


def stage(modifier: str, absent: str) -> Column:
    """Rows that wait for a stage: last touched by ``modifier`` and without the field it fills."""
    return F.col("lastModifier").eqNullSafe(modifier) & F.col(absent).isNull()


def compose(ids: list | None = None, outlets: list[str] | None = None, begin: str | None = None, end: str | None = None, state: Column | None = None) -> Column:
    """A list of ids overrides all other filters; otherwise they all hold, with a body."""
    if ids:
        return F.col("_id").isin(list(ids))
    out = body_not_empty()
    if outlets:
        out = out & in_outlets(outlets)
    if begin:
        out = out & (F.col("publishedAt") >= F.lit(begin).cast("timestamp"))
    if end:
        out = out & (F.col("publishedAt") < F.lit(end).cast("timestamp") + F.expr("interval 1 day"))
    return out & state if state is not None else out


def check_window(begin: str, end: str, lowest: str, now: dt.date) -> None:
    """The dates a service answers for; ValueError outside."""
    a, b = dt.date.fromisoformat(begin), dt.date.fromisoformat(end)
    if a < dt.date.fromisoformat(lowest) or b > now + dt.timedelta(days=1) or a > b:
        raise ValueError(f"dates from {lowest} to {now} are available, not {begin} to {end}")

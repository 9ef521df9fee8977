"""Character spans: parsing, overlap, coverage."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_span(text: Column) -> Column:
    """'(12,34)' or '(12, 34)' as struct<start, end>; null for anything else."""
    pattern = r"^\((\d+), ?(\d+)\)$"
    return F.when(text.rlike(pattern), F.struct(F.regexp_extract(text, pattern, 1).cast("int").alias("start"), F.regexp_extract(text, pattern, 2).cast("int").alias("end")))


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Characters that two spans share; at least zero, null if a bound is."""
    known = (a_start + a_end + b_start + b_end).isNotNull()  # least and greatest pass over nulls
    return F.when(known, F.greatest(F.least(a_end, b_end) - F.greatest(a_start, b_start), F.lit(0)))


def covers(a_start: Column, a_end: Column, b_start: Column, b_end: Column, least: int = 2) -> Column:
    """Whether two spans share at least ``least`` characters; null if a bound is."""
    return (a_end - b_start >= least) & (b_end - a_start >= least) & (a_end - a_start >= least) & (b_end - b_start >= least)


def overlap_share(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """|a ∩ b| / |a|; zero for an empty a."""
    return F.coalesce(F.try_divide(overlap(a_start, a_end, b_start, b_end), a_end - a_start), F.lit(0.0))


def covers_all(a: Column, b: Column, least: int = 1) -> Column:
    """Every span of each array shares characters with a span of the other."""
    hit = lambda x, y: F.least(x["end"], y["end"]) - F.greatest(x["start"], y["start"]) >= least
    return F.forall(a, lambda x: F.exists(b, lambda y: hit(x, y))) & F.forall(b, lambda y: F.exists(a, lambda x: hit(x, y)))

"""Counts of articles, quotes, people, sources and authors; top sources; roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsweft.operators.predicates import body_not_empty

GENDERS = ("Female", "Male", "Unknown")


def latest(articles: DataFrame, *columns: str, key: str = "_id", order: str = "lastModified") -> DataFrame:
    """One row per key, the last delivered; only ``columns`` travel through the shuffle."""
    row = F.max_by(F.struct(*columns), F.struct(order))
    return articles.groupBy(key).agg(row.alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in columns])


def totals(articles: DataFrame, kinds: tuple[str, ...] = ("people", "sources", "authors"), by: list[str] = ()) -> DataFrame:
    """totalArticles, totalQuotes and a sum for each kind and gender; no row for empty input."""
    sums = [F.coalesce(F.sum(f"{k}{g}Count"), F.lit(0)).cast("long").alias(f"{k}{g}Count") for k in kinds for g in GENDERS]
    agg = [F.count("*").alias("totalArticles"), F.coalesce(F.sum("quoteCount"), F.lit(0)).cast("long").alias("totalQuotes"), *sums]
    return articles.groupBy(*by).agg(*agg).where("totalArticles > 0")


def top_sources(articles: DataFrame, fields: list[str], limit: int = 100, ascending: bool = False) -> DataFrame:
    """(name, count) over the arrays ``fields``; ties by name."""
    names = F.concat(*[F.coalesce(F.col(f), F.array().cast("array<string>")) for f in fields])
    counts = articles.select(F.explode(names).alias("name")).groupBy("name").agg(F.count("*").alias("count"))
    return counts.orderBy(F.asc("count") if ascending else F.desc("count"), "name").limit(limit)


def source_totals(articles: DataFrame, by: list[str]) -> DataFrame:
    """Articles and their sources by gender."""
    sums = {"totalMaleSources": "sourcesMaleCount", "totalFemaleSources": "sourcesFemaleCount", "totalUnknownSources": "sourcesUnknownCount"}
    return articles.groupBy(*by).agg(F.count("*").alias("totalArticles"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in sums.items()])


def daily_counts(articles: DataFrame, with_body: bool = False, name: str = "numArticles") -> DataFrame:
    """Articles for each day and outlet."""
    rows = articles.where(body_not_empty()) if with_body else articles
    return rows.groupBy(F.to_date("publishedAt").alias("day"), "outlet").agg(F.count("*").alias(name))


def media_daily(articles: DataFrame) -> DataFrame:
    """The daily roll-up; articles without annotation count with no sources."""
    sums = {"totalFemales": "sourcesFemaleCount", "totalMales": "sourcesMaleCount", "totalUnknowns": "sourcesUnknownCount"}
    rows = articles.where(body_not_empty())
    return rows.groupBy(F.to_date("publishedAt").alias("day"), "outlet").agg(F.count("*").alias("totalArticles"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in sums.items()])


def monthly_top_sources(articles: DataFrame, limit: int = 50, genders: tuple[str, ...] = GENDERS) -> DataFrame:
    """(gender, rank, name, count) of one month's articles."""
    parts = []
    for g in genders:
        top = top_sources(articles, [f"sources{g}"], limit)
        parts.append(top.select(F.lit(g.lower()).alias("gender"), "name", "count"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def as_document(top: DataFrame, month: str) -> DataFrame:
    """One nested row for a month: its lists of top sources and a comment."""
    lists = [F.array_sort(F.collect_list(F.when(F.col("gender") == g, F.struct((-F.col("count")).alias("order"), "name", "count")))) for g in ("female", "male", "unknown")]
    names = ("topFemaleSources", "topMaleSources", "topUnknownSources")
    return top.agg(*[F.transform(x, lambda s: F.struct(s["name"].alias("name"), s["count"].alias("count"))).alias(n) for x, n in zip(lists, names)]).select(F.lit(month).alias("_id"), *names, F.lit("").alias("comment"))

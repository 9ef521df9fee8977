"""Queries that need typed dates and author genders, over articles built from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsweft.operators import predicates as pr, serving, stats, topics, upsert
from newsweft.sources.adapter import SQL as ADAPTER, order_articles
from newsweft.sources.tables import table

BEGIN, END, MONTH = "1996-01-01", "1998-12-31", (1997, 3)
SEGMENTS = ["AUTOMOBILE", "BUILDING", "MACHINERY"]
WITH = "WITH " + ADAPTER
_OK = "body IS DISTINCT FROM '' AND annotated"
_RANGE = f"publishedAt >= TIMESTAMP '{BEGIN}' AND publishedAt < TIMESTAMP '{END}' + INTERVAL 1 DAY"
_MONTH = "publishedAt >= TIMESTAMP '1997-03-01' AND publishedAt < TIMESTAMP '1997-04-01'"


def _articles(spark, d) -> DataFrame:
    return order_articles(spark, d)


def _ranged(spark, d) -> DataFrame:
    return _articles(spark, d).where(pr.body_not_empty() & F.col("annotated") & pr.in_outlets(SEGMENTS) & pr.days(BEGIN, END))


def ranged_outlet_stats(spark, d):
    return stats.totals(_ranged(spark, d), by=["outlet"])


def ranged_db_stats(spark, d):
    return stats.totals(_ranged(spark, d))


def _cohort(name):
    return lambda spark, d: stats.source_totals(_ranged(spark, d).where(pr.author_cohort(name)), ["outlet"])


def daily_article_counts(spark, d):
    return stats.daily_counts(_articles(spark, d).where(pr.days(BEGIN, END)))


def article_counts_rollup(spark, d):
    return stats.daily_counts(_articles(spark, d), True, "totalArticles")


def media_daily(spark, d):
    return stats.media_daily(_articles(spark, d))


def _month_rows(spark, d):
    return _articles(spark, d).where(pr.body_not_empty() & F.col("annotated") & pr.month(*MONTH))


def monthly_top_sources(spark, d):
    return stats.monthly_top_sources(_month_rows(spark, d))


def monthly_top_sources_timeseries(spark, d):
    return stats.monthly_top_sources(_month_rows(spark, d), genders=("Female", "Male")).select("name", F.lit("1997-03-01").cast("date").alias("date"), "count")


def _series(spark, d):
    rows = _articles(spark, d).where("annotated").select(F.trunc("publishedAt", "MM").alias("date"), F.explode(F.concat("sourcesFemale", "sourcesMale")).alias("name"))
    return rows.groupBy("name", "date").agg(F.count("*").alias("count"))


NAMES = ["Supplier#000000001", "Supplier#000000002"]


def source_trend_filled(spark, d):
    names = [r for r in NAMES]
    wide = serving.monthly_series(_series(spark, d), names)
    return wide.select("month", *[F.col(f"`{n}`").cast("long").alias(f"s{k}") for k, n in enumerate(names, 1)])


def replace_month_slice(spark, d):
    """State after one month's series is deleted and written again from a corrected count."""
    old = _series(spark, d).select("name", "date", "count")
    new = old.where(F.col("date") == F.lit("1997-03-01").cast("date")).withColumn("count", F.col("count") * 2)
    return upsert.replace_slice(old, new, "date")


def dominance_cohorts(spark, d):
    rows = _articles(spark, d).where("annotated").withColumn("cohort", pr.dominance(1)).where("cohort is not null")
    return rows.groupBy("outlet", "cohort").agg(F.count("*").alias("numArticles"), F.sum("sourcesFemaleCount").alias("female"), F.sum("sourcesMaleCount").alias("male"))


def top500_dominant(spark, d):
    rows = _articles(spark, d).where("annotated").withColumn("cohort", pr.dominance(1)).where("cohort is not null")
    parts = [rows.where(F.col("cohort") == c).orderBy(F.desc(f"sources{c.capitalize()}Count"), "_id").limit(500).select("_id", "cohort", F.col(f"sources{c.capitalize()}Count").cast("long").alias("n")) for c in ("female", "male")]
    return parts[0].unionByName(parts[1])


def date_range(spark, d):
    return _articles(spark, d).groupBy("outlet").agg(F.date_format(F.min("publishedAt"), "yyyy-MM-dd").alias("min_date"), F.date_format(F.max("publishedAt"), "yyyy-MM-dd").alias("max_date"))


def _lda(spark, d):
    docs = table(spark, d, "documents").where("text is not null and lang = 'en'").select(F.col("doc_id").alias("_id"), F.col("source").alias("outlet"), F.col("text").alias("body"), (F.col("doc_id") % 4).cast("int").alias("sourcesFemaleCount"), (F.col("doc_id") % 3).cast("int").alias("sourcesMaleCount"))
    model = topics.pipeline().fit(docs)
    return model, topics.distributions(model, docs, ["_id", "outlet", "sourcesFemaleCount", "sourcesMaleCount"])


def lda_topics(spark, d):
    return topics.describe(_lda(spark, d)[0], 10)


def lda_outlet_means(spark, d):
    return topics.means(_lda(spark, d)[1], ["outlet"])


def lda_gender_prominence(spark, d):
    return topics.gender_difference(_lda(spark, d)[1])


SPARK = {
    "ranged_db_stats": ranged_db_stats, "ranged_outlet_stats": ranged_outlet_stats,
    **{f"ranged_{c}_author_sources": _cohort(c) for c in pr.COHORTS},
    "daily_article_counts": daily_article_counts, "article_counts_rollup": article_counts_rollup, "media_daily": media_daily,
    "monthly_top_sources": monthly_top_sources, "monthly_top_sources_timeseries": monthly_top_sources_timeseries, "source_trend_filled": source_trend_filled, "replace_month_slice": replace_month_slice,
    "dominance_cohorts": dominance_cohorts, "top500_dominant": top500_dominant, "date_range": date_range,
    "lda_topics": lda_topics, "lda_outlet_means": lda_outlet_means, "lda_gender_prominence": lda_gender_prominence,
}

_SEG = ", ".join(f"'{s}'" for s in SEGMENTS)
_SUMS = ", ".join(f"coalesce(sum({c}),0)::BIGINT AS {k}{g}Count" for k, cs in (("people", ("pf", "pm", "pu")), ("sources", ("sf", "sm", "su")), ("authors", ("af", "am", "au"))) for c, g in zip(cs, ("Female", "Male", "Unknown")))
_RNG = f"FROM art WHERE {_OK} AND outlet IN ({_SEG}) AND {_RANGE}"
_NAMED = ", named AS (SELECT art._id, art.publishedAt, g, s_name AS name FROM art JOIN pers ON art._id = pers.l_orderkey WHERE {w} AND f > 0)"
_TOP = "SELECT gender, name, count FROM (SELECT g AS gender, name, count(*) AS count, row_number() OVER (PARTITION BY g ORDER BY count(*) DESC, name) AS rn FROM named GROUP BY 1, 2) WHERE rn <= 50"
_SERIES = _NAMED.format(w="annotated") + ", ser AS (SELECT name, date_trunc('month', publishedAt)::DATE AS date, count(*) AS count FROM named WHERE g IN ('female','male') GROUP BY 1, 2)"
_DOM = ", dom AS (SELECT *, CASE WHEN sf - sm >= 1 THEN 'female' WHEN sm - sf >= 1 THEN 'male' END AS cohort FROM art WHERE annotated)"

SQL = {
    "ranged_db_stats": f"{WITH} SELECT * FROM (SELECT count(*) AS totalArticles, coalesce(sum(quoteCount),0)::BIGINT AS totalQuotes, {_SUMS} {_RNG}) WHERE totalArticles > 0",
    "ranged_outlet_stats": f"{WITH} SELECT outlet, count(*) AS totalArticles, coalesce(sum(quoteCount),0)::BIGINT AS totalQuotes, {_SUMS} {_RNG} GROUP BY 1",
    **{f"ranged_{c}_author_sources": f"{WITH} SELECT outlet, count(*) AS totalArticles, coalesce(sum(sm),0)::BIGINT AS totalMaleSources, coalesce(sum(sf),0)::BIGINT AS totalFemaleSources, coalesce(sum(su),0)::BIGINT AS totalUnknownSources {_RNG} AND {cond.format(f='af', m='am')} GROUP BY 1" for c, cond in pr.COHORTS.items()},
    "daily_article_counts": f"{WITH} SELECT publishedAt::DATE AS day, outlet, count(*) AS numArticles FROM art WHERE {_RANGE} GROUP BY 1, 2",
    "article_counts_rollup": f"{WITH} SELECT publishedAt::DATE AS day, outlet, count(*) AS totalArticles FROM art WHERE body IS DISTINCT FROM '' GROUP BY 1, 2",
    "media_daily": f"{WITH} SELECT publishedAt::DATE AS day, outlet, count(*) AS totalArticles, coalesce(sum(sf),0)::BIGINT AS totalFemales, coalesce(sum(sm),0)::BIGINT AS totalMales, coalesce(sum(su),0)::BIGINT AS totalUnknowns FROM art WHERE body IS DISTINCT FROM '' GROUP BY 1, 2",
    "monthly_top_sources": WITH + _NAMED.format(w=f"{_OK} AND {_MONTH}") + " " + _TOP,
    "monthly_top_sources_timeseries": WITH + _NAMED.format(w=f"{_OK} AND {_MONTH}") + f" SELECT name, DATE '1997-03-01' AS date, count FROM ({_TOP}) WHERE gender IN ('female', 'male')",
    "source_trend_filled": WITH + _SERIES + ", p AS (SELECT * FROM ser WHERE name IN (" + ", ".join(f"'{n}'" for n in NAMES) + ")), m AS (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 MONTH))::DATE AS month FROM p) SELECT month, " + ", ".join(f"coalesce(sum(count) FILTER (name = '{n}'), 0)::BIGINT AS s{k}" for k, n in enumerate(NAMES, 1)) + " FROM m LEFT JOIN p ON p.date = m.month GROUP BY 1",
    "replace_month_slice": WITH + _SERIES + " SELECT name, date, CASE WHEN date = DATE '1997-03-01' THEN count * 2 ELSE count END AS count FROM ser",
    "dominance_cohorts": WITH + _DOM + " SELECT outlet, cohort, count(*) AS numArticles, sum(sf)::BIGINT AS female, sum(sm)::BIGINT AS male FROM dom WHERE cohort IS NOT NULL GROUP BY 1, 2",
    "top500_dominant": WITH + _DOM + " SELECT _id, cohort, n::BIGINT AS n FROM (SELECT _id, cohort, CASE cohort WHEN 'female' THEN sf ELSE sm END AS n, row_number() OVER (PARTITION BY cohort ORDER BY CASE cohort WHEN 'female' THEN sf ELSE sm END DESC, _id) AS rn FROM dom WHERE cohort IS NOT NULL) WHERE rn <= 500",
    "date_range": WITH + " SELECT outlet, strftime(min(publishedAt), '%Y-%m-%d') AS min_date, strftime(max(publishedAt), '%Y-%m-%d') AS max_date FROM art GROUP BY 1",
}

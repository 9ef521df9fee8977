"""From crawled pages to new articles: admission, first sight under any spelling, outcome tally."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsweft.functions import url as ux


def new_articles(pages: DataFrame, *known: DataFrame) -> DataFrame:
    """Pages whose address stands in none of the ``known`` tables under any spelling; one row per address.

    All spellings of an address share one identity, so one equi-join per table replaces a lookup of
    every spelling.
    """
    out = pages.withColumn("identity", ux.identity(F.col("url")))
    for table in known:
        out = out.join(table.select(ux.identity(F.col("url")).alias("identity")).distinct(), "identity", "left_anti")
    return out.dropDuplicates(["identity"]).drop("identity")


def classify(pages: DataFrame, known: DataFrame, rejected: DataFrame) -> DataFrame:
    """(url, status): URL Present, Invalid Body or Inserted."""
    ident = ux.identity(F.col("url"))
    seen = known.select(ident.alias("identity")).unionByName(rejected.select(ident.alias("identity"))).distinct().withColumn("seen", F.lit(True))
    out = pages.withColumn("identity", ident).join(seen, "identity", "left")
    status = F.when(F.col("seen"), "URL Present").when(F.col("body").isNull() | (F.trim("body") == ""), "Invalid Body").otherwise("Inserted")
    return out.select("url", status.alias("status"))


def tally(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status").agg(F.count("*").alias("n"))


def crawl_order(tasks: DataFrame) -> DataFrame:
    """Distinct tasks, the most urgent first."""
    return tasks.withColumn("identity", ux.identity(F.col("url"))).groupBy("identity").agg(F.min("priority").alias("priority"), F.min("url").alias("url")).orderBy("priority", "url").select("priority", "url")

"""The daily roll-up as a stream: late articles change their day, writes are idempotent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from newsweft.functions import url as ux
from newsweft.operators.upsert import upsert_partitions


def daily_stream(articles: DataFrame, lateness: str = "90 days") -> DataFrame:
    """(day, outlet, totals) over a stream with ``publishedAt``; rows later than ``lateness`` are dropped by the watermark."""
    rows = articles.withWatermark("publishedAt", lateness).where(~F.col("body").eqNullSafe(""))
    sums = {"totalFemales": "sourcesFemaleCount", "totalMales": "sourcesMaleCount", "totalUnknowns": "sourcesUnknownCount"}
    out = rows.groupBy(F.window("publishedAt", "1 day"), "outlet").agg(F.count("*").alias("totalArticles"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in sums.items()])
    return out.select(F.col("window.start").cast("date").alias("day"), "outlet", "totalArticles", *sums)


def first_seen(articles: DataFrame, lateness: str = "90 days") -> DataFrame:
    """The first delivery of every address, whatever its scheme and spelling, within the lateness."""
    rows = articles.withWatermark("publishedAt", lateness).withColumn("__identity", ux.identity(F.col("url")))
    return rows.dropDuplicatesWithinWatermark(["__identity"]).drop("__identity")


def stage_ready(articles: DataFrame, stage: Column) -> DataFrame:
    """The rows of a stream of deliveries that a stage is due for; ``stage`` is one of the gates of ``predicates``."""
    return articles.where(stage)


def write_daily(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Upserts every micro-batch into a Parquet table partitioned by day; replaying a batch changes nothing.

    Only the days of the batch are read and replaced; an unreadable table is an error, never taken for none.
    """

    def write(batch: DataFrame, _: int) -> None:
        upsert_partitions(batch, path, ["day", "outlet"], "day")

    return stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()

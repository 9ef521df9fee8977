"""Ratios, weeks, filled series, rolling means and trends over roll-up tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def ratio0(a: Column, b: Column) -> Column:
    """a / b with 0.0 for a missing or zero denominator."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def with_shares(sums: DataFrame) -> DataFrame:
    """totalGenders and each gender's share of it."""
    total = F.col("totalFemales") + F.col("totalMales") + F.col("totalUnknowns")
    out = sums.withColumn("totalGenders", total)
    for one, many in (("perFemales", "totalFemales"), ("perMales", "totalMales"), ("perUnknowns", "totalUnknowns")):
        out = out.withColumn(one, ratio0(F.col(many), F.col("totalGenders")))
    return out


def sums(daily: DataFrame, by: list[Column | str]) -> DataFrame:
    cols = ("totalArticles", "totalFemales", "totalMales", "totalUnknowns")
    return daily.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in cols])


def info_by_date(daily: DataFrame) -> DataFrame:
    """Per outlet: sums, shares and the share of all articles."""
    out = with_shares(sums(daily, ["outlet"]))
    return out.withColumn("perArticles", ratio0(F.col("totalArticles"), F.sum("totalArticles").over(Window.partitionBy())))


def info_total(daily: DataFrame) -> DataFrame:
    """The same over all outlets in one row; none for empty input."""
    return with_shares(sums(daily, [F.lit("all").alias("outlet")])).where("totalArticles is not null")


def week_begin(day: Column) -> Column:
    """The Sunday on or before a day."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def week_end(day: Column) -> Column:
    """The Sunday on or after a day."""
    return F.next_day(F.date_sub(day, 1), "SUN")


def weekly_info(daily: DataFrame) -> DataFrame:
    """Shares for each outlet and week from Sunday to Saturday; a week across new year is one week."""
    begin = week_begin(F.to_date("publishedAt"))
    out = with_shares(sums(daily, ["outlet", begin.alias("weekBegin")]))
    return out.withColumn("weekEnd", F.date_add("weekBegin", 6))


def complete_grid(rows: DataFrame, key: str, date: str, step: str, values: dict[str, object]) -> DataFrame:
    """Every date from first to last in steps, for every key; absent values are filled."""
    span = rows.agg(F.min(date).alias("a"), F.max(date).alias("b"), F.lit(1).alias("one"))
    keys = rows.select(key).distinct().withColumn("one", F.lit(1)).join(F.broadcast(span), "one")  # one row
    grid = keys.where("a is not null").select(key, F.explode(F.sequence("a", "b", F.expr(step))).alias(date))
    return grid.join(rows, [key, date], "left").fillna(values)


def hide_future(weeks: DataFrame, today: Column | None = None, week: str = "week") -> DataFrame:
    """Only weeks that have ended by ``today`` (the current day); a week is named by the Sunday it ends on."""
    return weeks.where(F.col(week) <= (F.current_date() if today is None else today))


def display_names(rows: DataFrame, names: dict[str, str], column: str = "outlet") -> DataFrame:
    """Outlets under the names they are shown by; others keep theirs."""
    return rows.replace(names, subset=[column]) if names else rows


def weekly_counts(daily: DataFrame) -> DataFrame:
    """(outlet, week, totalArticles): weeks that end on Sunday, empty weeks with 0."""
    weeks = daily.groupBy("outlet", week_end(F.to_date("publishedAt")).alias("week")).agg(F.coalesce(F.sum("totalArticles"), F.lit(0)).cast("long").alias("totalArticles"))
    return complete_grid(weeks, "outlet", "week", "interval 7 days", {"totalArticles": 0})


def female_share(daily: DataFrame, fill: bool = False) -> DataFrame:
    """(outlet, day, share in per cent); days without any source have none. ``fill`` adds absent days as 0.

    A day that is there but has no source is undefined, not 0: it counts in the span of days and is left out.
    """
    day = daily.groupBy("outlet", F.to_date("publishedAt").alias("day")).agg(*[F.sum(c).alias(c) for c in ("totalFemales", "totalMales", "totalUnknowns")])
    share = F.try_divide(100.0 * F.col("totalFemales"), F.col("totalFemales") + F.col("totalMales") + F.col("totalUnknowns"))
    out = day.select("outlet", "day", share.alias("share"), F.lit(True).alias("present"))
    if fill:
        out = complete_grid(out, "outlet", "day", "interval 1 day", {"present": False}).withColumn("share", F.when(F.col("present"), F.col("share")).otherwise(0.0))
    return out.where("share is not null").drop("present")


def rolling_share(shares: DataFrame, rows: int = 7, legacy_unpartitioned: bool = False) -> DataFrame:
    """Mean of the last ``rows`` days of each outlet; the legacy form runs on across outlets."""
    w = Window.orderBy("outlet", "day") if legacy_unpartitioned else Window.partitionBy("outlet").orderBy("day")
    return shares.withColumn("rolling", F.avg("share").over(w.rowsBetween(1 - rows, 0)))


def trend(shares: DataFrame) -> DataFrame:
    """Least-squares slope and intercept of each outlet's share over days since 1970."""
    x = F.datediff("day", F.lit("1970-01-01").cast("date")).cast("double")
    return shares.groupBy("outlet").agg(F.regr_slope("share", x).alias("slope"), F.regr_intercept("share", x).alias("intercept"), F.count("*").alias("days"))


def alias_merge(counts: DataFrame, aliases: DataFrame, by: list[str] = ()) -> DataFrame:
    """Names replaced by their primary spelling (alias, primary), counts added up again."""
    renamed = counts.join(aliases, F.col("name") == F.col("alias"), "left").withColumn("name", F.coalesce("primary", "name"))
    return renamed.groupBy(*by, "name").agg(F.sum("count").cast("long").alias("count"))


def top_per_group(rows: DataFrame, group: str, n: int, value: str = "count", tie: str = "name") -> DataFrame:
    w = Window.partitionBy(group).orderBy(F.desc(value), tie)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def monthly_series(rows: DataFrame, names: list[str]) -> DataFrame:
    """(month, one column per name) with zeros for absent months; ``rows``: name, date, count."""
    picked = rows.where(F.col("name").isin(names)).groupBy(F.trunc("date", "MM").alias("month")).pivot("name", names).agg(F.sum("count"))
    span = picked.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a is not null")
    months = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    return months.join(picked, "month", "left").fillna(0)

"""Names to genders by a cascade of caches, each a broadcast or shuffled equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsweft.functions.text import accent_fold, first_name, french_title_gender, name_length_is_invalid


def cache_key(name: Column, language: str = "en") -> Column:
    """Lower case; English without accents, French with them."""
    folded = F.replace(name, F.lit(" "), F.lit(" "))
    return F.lower(accent_fold(folded) if language == "en" else folded)


def normal_gender(gender: Column) -> Column:
    """female or male from their spellings; anything else is unknown."""
    low = F.lower(F.trim(gender))
    return F.when(low.isin("female", "f"), "female").when(low.isin("male", "m"), "male").otherwise("unknown")


def name_cache(cache: DataFrame, language: str = "en") -> DataFrame:
    """(key, gender) of a cache table; entries of unknown gender fall through, disagreeing ones go to the first in order."""
    known = cache.select(cache_key(F.col("name"), language).alias("key"), normal_gender(F.col("gender")).alias("gender")).where("gender <> 'unknown'")
    return known.groupBy("key").agg(F.min("gender").alias("gender"))


def first_name_cache(cache: DataFrame, language: str = "en") -> DataFrame:
    """(key, gender) of first names whose bearers agree."""
    known = cache.select(first_name(cache_key(F.trim("name"), language)).alias("key"), normal_gender(F.col("gender")).alias("gender")).where("key is not null and gender <> 'unknown'")
    return known.groupBy("key").agg(F.min("gender").alias("gender"), F.max("gender").alias("other")).where("gender = other").select("key", "gender")


def cascade(names: DataFrame, full: list[DataFrame], first: list[DataFrame], language: str = "en") -> DataFrame:
    """(name, gender): full-name caches in order, then first-name caches; too short or long names are unknown.

    ``names``: column ``name``; caches: (key, gender), one row per key.
    """
    out = names.select("name").distinct().withColumn("k", cache_key(F.col("name"), language)).withColumn("f", first_name(cache_key(F.trim("name"), language)))
    found = []
    for n, cache in enumerate([*full, *first]):
        side = "k" if n < len(full) else "f"
        out = out.join(cache.select(F.col("key").alias(side), F.col("gender").alias(f"g{n}")), side, "left")
        found.append(F.col(f"g{n}"))
    gender = F.coalesce(*found, F.lit("unknown")) if found else F.lit("unknown")
    return out.select("name", F.when(name_length_is_invalid(F.col("name")), "unknown").otherwise(gender).alias("gender"))


def french_cascade(names: DataFrame, full: list[DataFrame], first: list[DataFrame]) -> DataFrame:
    """French titles decide first."""
    by_cache = cascade(names, full, first, "fr")
    return by_cache.withColumn("gender", F.coalesce(french_title_gender(F.col("name")), "gender"))


def people_by_gender(articles: DataFrame, genders: DataFrame, field: str = "people") -> DataFrame:
    """(_id, gender, n, names): distinct names of each article by gender."""
    rows = articles.select("_id", F.explode(F.array_distinct(field)).alias("name")).join(genders, "name", "left")
    out = rows.groupBy("_id", F.coalesce("gender", F.lit("unknown")).alias("gender")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("names"))
    return out


def cache_updates(entries: DataFrame, language: str = "en") -> DataFrame:
    """(name, gender) rows to upsert: the name as given and its plain form, lower case."""
    both = F.array_distinct(F.array(F.lower("name"), F.lower(accent_fold(F.col("name"))))) if language == "en" else F.array(F.lower("name"))
    return entries.select(F.explode(both).alias("name"), "gender").distinct()

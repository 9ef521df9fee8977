"""Analysis of single texts: quotes, people and sources with genders, and counts for charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsweft.operators import gender, quotes
from newsweft.operators.predicates import MAX_BODY


def analyze(texts: DataFrame, caches: list[DataFrame], first_caches: list[DataFrame], key: str = "_id", text: str = "body") -> tuple[DataFrame, DataFrame]:
    """((key, quotes), (key, role, gender, n, names)) of texts of at most 20,000 characters.

    People are capitalised names of two to six tokens; sources are those who speak a quote, and
    count among the people.
    """
    rows = texts.where(F.length(text).between(1, MAX_BODY))
    said = quotes.extract(rows, quotes.english_quotes, key=key, text=text)
    speakers = said.select(key, F.explode(F.array_distinct(F.filter(F.transform("quotes", lambda q: q["speaker"]), lambda s: s != ""))).alias("name"))
    named = rows.select(key, F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(r"\b\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?(?: \p{Lu}\.?)?(?: \p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?){1,4}\b"), F.lit(0)))).alias("name"))
    people = named.unionByName(speakers).distinct()
    genders = gender.cascade(people.select("name"), caches, first_caches)
    roles = people.withColumn("role", F.lit("people")).unionByName(speakers.distinct().withColumn("role", F.lit("sources")))
    table = roles.join(genders, "name").groupBy(key, "role", "gender").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("names"))
    return said, table


def pie_counts(table: DataFrame, key: str = "_id") -> DataFrame:
    """(key, role, female, male, unknown)."""
    return table.groupBy(key, "role").pivot("gender", ["female", "male", "unknown"]).agg(F.sum("n")).fillna(0)

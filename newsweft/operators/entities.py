"""Author lists, entity merging, and alignment of quotes with people."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from newsweft.functions.spans import covers, covers_all, parse_span
from newsweft.functions.text import almost_same, blocked_substring, blocked_token, clean_name


def dedupe_authors(authors: Column) -> Column:
    """Names that contain another name of the list go; the shorter stays. Order and equal names: first kept."""
    once = F.array_distinct(authors)
    return F.filter(once, lambda a: ~F.exists(once, lambda b: (F.lower(a) != F.lower(b)) & F.contains(F.lower(a), F.lower(b)) & (b != "")))


def clean_authors(authors: Column, blocklist: list[str], language: str = "en") -> Column:
    """Valid names (more than one token, nothing blocked), without duplicates, cleaned, without empties; null gives an empty list."""
    blocked = blocked_token if language == "en" else blocked_substring
    valid = F.filter(F.coalesce(authors, F.array().cast("array<string>")), lambda a: F.coalesce(F.size(F.split(F.trim(a), r"\s+")) > 1, F.lit(False)) & ~F.coalesce(blocked(a, blocklist), F.lit(False)))
    out = dedupe_authors(valid)
    if language == "en":
        out = F.transform(out, clean_name)
    return F.filter(out, lambda a: a != "")


def align_quotes(quotes: DataFrame, mentions: DataFrame, least: int = 2) -> DataFrame:
    """(doc, quote, entity): the first entity, in order, one of whose mentions shares ``least`` characters with the speaker.

    ``quotes``: doc, quote, s_start, s_end; ``mentions``: doc, entity, seq, m_start, m_end. A null
    speaker span is never aligned; unaligned quotes have a null entity.
    """
    hit = quotes.join(mentions, "doc").where(covers(F.col("s_start"), F.col("s_end"), F.col("m_start"), F.col("m_end"), least))
    first = hit.groupBy("doc", "quote").agg(F.min_by("entity", F.struct("seq", "m_start", "entity")).alias("entity"))
    return quotes.select("doc", "quote").join(first, ["doc", "quote"], "left")


def fallback_entity(aligned: DataFrame, quotes: DataFrame, ner: DataFrame, least: int = 2) -> DataFrame:
    """(doc, quote, entity, type): PERSON if aligned, else any named span there, else UNKNOWN."""
    any_hit = quotes.join(ner, "doc").where(covers(F.col("s_start"), F.col("s_end"), F.col("m_start"), F.col("m_end"), least))
    other = any_hit.groupBy("doc", "quote").agg(F.min_by(F.struct("label", "text"), F.struct("m_start", "m_end")).alias("o"))
    out = aligned.join(other, ["doc", "quote"], "left")
    return out.select("doc", "quote", F.coalesce("entity", "o.text", F.lit("")).alias("entity"), F.when(F.col("entity").isNotNull(), "PERSON").otherwise(F.coalesce("o.label", F.lit("UNKNOWN"))).alias("type"))


def quote_rows(articles: DataFrame, field: str = "quotesUpdated") -> DataFrame:
    """One row per quote: doc, quote number, and its parsed spans."""
    rows = articles.select(F.col("_id").alias("doc"), F.posexplode(field).alias("quote", "q"))
    return rows.select(
        "doc", "quote", F.col("q.speaker").alias("speaker"), F.col("q.quote").alias("text"), F.col("q.verb").alias("verb"), F.col("q.quote_type").alias("quote_type"), F.col("q.quote_token_count").alias("tokens"),
        F.col("q.is_floating_quote").alias("floating"), parse_span(F.col("q.speaker_index")).alias("s"), parse_span(F.col("q.quote_index")).alias("t"), parse_span(F.col("q.verb_index")).alias("v"),
    )


def floating_reference(quotes: DataFrame) -> DataFrame:
    """Speakerless quotes take the last speaker before them (as-of, backward)."""
    w = Window.partitionBy("doc").orderBy("q_start", "quote").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("speaker") != "", F.col("speaker")), ignorenulls=True).over(w)
    return quotes.withColumn("reference", F.when(F.coalesce(F.col("speaker") != "", F.lit(False)), F.col("speaker")).otherwise(last))


def heads_match(speaker_heads: Column, mention_heads: Column) -> Column:
    """All heads of each side are covered by the other."""
    return covers_all(speaker_heads, mention_heads)


def self_evident(reference: Column, name: Column) -> Column:
    """A reference that is a name but for two letters."""
    return almost_same(reference, name, 2)


def sources(people: Column, references: Column) -> Column:
    """People of the article who are referred to by a quote."""
    return F.array_intersect(people, references)


def mergeable(a: str, b: str) -> bool:
    """Whether two English names mean one person; case matters and parts begin with capitals.

    Two parts and their first name alone; three parts and the last two, or the last alone. The longer string is the full name.
    """
    y, x = (s.split(" ") for s in sorted((a.strip(), b.strip()), key=len))
    capitals = lambda *parts: all(p[:1].isupper() for p in parts)
    match len(x), len(y):
        case 2, 1:
            return x[0] == y[0] and capitals(*x)
        case 3, 2:
            return x[1:] == y and capitals(*x)
        case 3, 1:
            return x[2] == y[0] and capitals(x[0], x[2])
    return False


def merged_names(names: list[str]) -> list[tuple[str, list[str]]]:
    """(entity, its names) of one document: each name in turn joins the first entity whose fullest name it can mean.

    A fuller name takes the entity over and moves it behind the others. Entities of one token go.
    """
    groups: list[tuple[str, list[str]]] = []
    for name in dict.fromkeys(names):
        home = next((g for g in groups if mergeable(name, g[0])), None)
        if home is None:
            groups.append((name, [name]))
        elif len(name) > len(home[0]):
            groups.remove(home)
            groups.append((name, [*home[1], name]))
        else:
            home[1].append(name)
    return [g for g in groups if " " in g[0]]


def merge_names(mentions: DataFrame) -> DataFrame:
    """(doc, name, entity): in the order of ``seq`` each name joins the first earlier entity it can mean; entities of one token go.

    The merge depends on order within a document, so one row holds a document's names and batches of rows go to Python.
    """

    @F.pandas_udf("array<struct<entity string, names array<string>>>")
    def merged(names: pd.Series) -> pd.Series:
        return names.map(lambda ns: [{"entity": e, "names": g} for e, g in merged_names(list(ns))])

    ordered = F.transform(F.array_sort(F.collect_list(F.struct("seq", "name"))), lambda x: x["name"])
    lists = mentions.where("name is not null and name <> ''").groupBy("doc").agg(ordered.alias("names"))
    groups = lists.select("doc", F.explode(merged("names")).alias("g"))
    return groups.select("doc", F.explode("g.names").alias("name"), F.col("g.entity").alias("entity"))


def mergeable_fr(a: str, b: str, gender_a: str | None = None, gender_b: str | None = None) -> bool:
    """French names: first and last parts agree but for one letter, unless their titles tell different genders."""
    if gender_a and gender_b and gender_a != gender_b:
        return False
    x, y = a.lower().split(), b.lower().split()
    if not x or not y:
        return False
    near = lambda p, q: p == q or (abs(len(p) - len(q)) <= 1 and _one_edit(p, q))
    if len(x) == 1 or len(y) == 1:
        return near(x[-1], y[-1])
    return near(x[0], y[0]) and near(x[-1], y[-1])


def _one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]

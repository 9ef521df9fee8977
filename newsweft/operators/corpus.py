"""Corpus statistics: frequencies, document range, keyness, collocates, lemmas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsweft.functions.text import topic_tokens


def tokens(docs: DataFrame, key: str, text: str, keep: list[str] = ()) -> DataFrame:
    """(key, pos, word, *keep)."""
    return docs.select(key, *keep, F.posexplode(topic_tokens(F.col(text))).alias("pos", "word"))


def frequencies(rows: DataFrame, by: list[str] = ()) -> DataFrame:
    return rows.groupBy(*by, "word").agg(F.count("*").alias("n"))


def document_range(rows: DataFrame, key: str, by: list[str] = ()) -> DataFrame:
    """(word, docs): in how many documents a word stands."""
    return rows.select(key, *by, "word").distinct().groupBy(*by, "word").agg(F.count("*").alias("docs"))


def keyness(first: DataFrame, second: DataFrame, smooth: float = 0.5) -> DataFrame:
    """(word, n1, n2, log_ratio): binary logarithm of the ratio of relative frequencies, with add-``smooth``."""
    a, b = first.select("word", F.col("n").alias("n1")), second.select("word", F.col("n").alias("n2"))
    both = a.join(b, "word", "full").fillna(0)
    sizes = both.agg(F.sum("n1").alias("t1"), F.sum("n2").alias("t2"))
    joined = both.withColumn("k", F.lit(1)).join(F.broadcast(sizes.withColumn("k", F.lit(1))), "k")
    ratio = F.log2(((F.col("n1") + smooth) / (F.col("t1") + smooth)) / ((F.col("n2") + smooth) / (F.col("t2") + smooth)))
    return joined.select("word", "n1", "n2", ratio.alias("log_ratio"))


def neighbour_pairs(rows: DataFrame, key: str) -> DataFrame:
    """(a, b, n): words that follow each other."""
    w = Window.partitionBy(key).orderBy("pos")
    return rows.select("word", F.lead("word").over(w).alias("b")).where("b is not null").groupBy(F.col("word").alias("a"), "b").agg(F.count("*").alias("n"))


def mutual_information(pairs: DataFrame, freq: DataFrame, least: int = 3) -> DataFrame:
    """(a, b, n, mi): log2 of the joint over the product of the shares."""
    total_pairs, total = pairs.agg(F.sum("n").alias("tp"), F.lit(1).alias("k")), freq.agg(F.sum("n").alias("t"), F.lit(1).alias("k"))
    x = pairs.where(F.col("n") >= least).join(freq.select(F.col("word").alias("a"), F.col("n").alias("na")), "a").join(freq.select(F.col("word").alias("b"), F.col("n").alias("nb")), "b")
    x = x.withColumn("k", F.lit(1)).join(F.broadcast(total_pairs), "k").join(F.broadcast(total), "k")
    mi = F.log2((F.col("n") / F.col("tp")) / ((F.col("na") / F.col("t")) * (F.col("nb") / F.col("t"))))
    return x.select("a", "b", "n", mi.alias("mi"))


def lemmatise(words: Column, lemmas: Column) -> Column:
    """Words looked up in a map column; unknown ones stay."""
    return F.transform(words, lambda w: F.coalesce(F.try_element_at(lemmas, w), w))


def dependency_bigrams(docs: DataFrame, key: str, dep: str = "dobj", banned: list[tuple[str, str]] = ()) -> DataFrame:
    """(head, word, n, docs) over a token column of struct<i, lemma, dep, head>."""
    rows = docs.select(key, F.explode("tokens").alias("t"), "tokens").where(F.col("t.dep") == dep)
    head = F.element_at(F.filter("tokens", lambda x: x["i"] == F.col("t.head")), 1)
    pairs = rows.select(key, F.lower(head["lemma"]).alias("head"), F.lower("t.lemma").alias("word")).where("head is not null")
    for h, w in banned:
        pairs = pairs.where(~((F.col("head") == h) & (F.col("word") == w)))
    return pairs.groupBy("head", "word").agg(F.count("*").alias("n"), F.count_distinct(key).alias("docs"))


def pos_frequencies(docs: DataFrame, tag: str) -> DataFrame:
    """(word, n) of tokens whose part of speech contains ``tag``."""
    rows = docs.select(F.explode("tokens").alias("t")).where(F.contains(F.col("t.pos"), F.lit(tag)))
    return rows.groupBy(F.lower("t.text").alias("word")).agg(F.count("*").alias("n"))


def stopword_forms(roots: DataFrame, lemmas: DataFrame) -> DataFrame:
    """(word): light verbs and all forms of them through the lemma table (form, lemma)."""
    forms = lemmas.join(roots.select(F.col("word").alias("lemma")), "lemma").select(F.col("form").alias("word"))
    return forms.unionByName(roots.select("word")).distinct().orderBy("word")

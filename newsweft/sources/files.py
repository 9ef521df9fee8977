"""Readers and writers of the file forms around the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T


def folder_texts(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(id, text) of every file; the id is the name up to its first dot. Unreadable files are passed over."""
    df = spark.read.option("ignoreCorruptFiles", "true").text(path, wholetext=True)
    out = df.select(F.regexp_extract(F.input_file_name(), r"([^/.]+)[^/]*$", 1).alias("id"), F.col("value").alias("text"))
    return out.orderBy("id").limit(limit) if limit else out


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """(word): one to a line, trimmed, without empties."""
    return spark.read.text(path).select(F.trim("value").alias("word")).where("word <> ''").distinct()


def lemma_table(spark: SparkSession, path: str) -> DataFrame:
    """(form, lemma) of lines 'lemma -> form form …'; short lines are skipped, the first mapping of a form wins."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), F.split(F.trim("value"), r"\s+").alias("t")).where(F.size("t") > 2)
    rows = lines.select("line", F.col("t")[0].alias("lemma"), F.explode(F.slice("t", 3, 100_000)).alias("form"))
    w = Window.partitionBy("form").orderBy("line", "lemma")
    return rows.withColumn("n", F.row_number().over(w)).where("n = 1").select("form", "lemma")


def lemma_lines(pairs: DataFrame, banned: list[str] = ("datum",)) -> DataFrame:
    """(value): 'lemma -> form form …' of alphabetic lower-case pairs (form, lemma)."""
    rows = pairs.select(F.lower("form").alias("form"), F.lower("lemma").alias("lemma")).where(F.col("form").rlike("^[a-z]+$") & F.col("lemma").rlike("^[a-z]+$") & ~F.col("lemma").isin(*banned))
    return rows.groupBy("lemma").agg(F.array_sort(F.collect_set("form")).alias("forms")).select(F.concat(F.col("lemma"), F.lit(" -> "), F.array_join("forms", " ")).alias("value"))


def alias_table(spark: SparkSession, path: str) -> DataFrame:
    """(alias, primary) of lines 'primary, alias, alias …' below a header."""
    lines = spark.read.text(path).where(~F.lower(F.col("value")).startswith("primary")).select(F.transform(F.split("value", ","), F.trim).alias("t")).where(F.size("t") > 1)
    return lines.select(F.explode(F.slice("t", 2, 1000)).alias("alias"), F.col("t")[0].alias("primary")).where("alias <> ''")


def name_rules(spark: SparkSession, path: str) -> DataFrame:
    """(label, phrase): patterns given as a string or as a list of tokens."""
    raw = spark.read.text(path).select(F.get_json_object("value", "$.label").alias("label"), F.get_json_object("value", "$.pattern").alias("p"))
    words = F.from_json("p", T.ArrayType(T.MapType(T.StringType(), T.StringType())))
    phrase = F.when(F.col("p").startswith("["), F.array_join(F.transform(words, lambda m: F.coalesce(m["LOWER"], m["ORTH"], m["TEXT"])), " ")).otherwise(F.col("p"))
    return raw.select("label", phrase.alias("phrase")).where("phrase is not null")


def articles_json(spark: SparkSession, path: str) -> DataFrame:
    """Article exports with dates such as {"$date": milliseconds} in publishedAt."""
    df = spark.read.json(path)
    if isinstance(df.schema["publishedAt"].dataType, T.StructType):
        df = df.withColumn("publishedAt", F.timestamp_millis(F.col("publishedAt.`$date`").cast("long")))
    return df


def read_split(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A topic split: CSV with header and a given schema."""
    return spark.read.csv(path, header=True, schema=schema)


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").csv(path, header=True)


def write_quotes(quotes: DataFrame, path: str, key: str = "_id") -> None:
    """One folder of JSON lines per document."""
    quotes.write.mode("overwrite").partitionBy(key).json(path)


def ld_json(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, json) of every ld+json script."""
    found = F.regexp_extract_all(F.col(html), F.lit(r'(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>'), F.lit(1))
    return pages.select(key, F.explode(found).alias("json"))


def links(pages: DataFrame, pattern: str = r'(?i)href="([^"]+)"', key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, url) of the links that an outlet's pattern picks out."""
    return pages.select(key, F.explode(F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1)))).alias("url"))

"""Monthly topic models and the prominence of topics by outlet and source gender."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from newsweft.operators.predicates import dominance


def pipeline(topics: int = 15, iterations: int = 150, vocabulary: int = 5000, min_df: float = 0.02, max_df: float = 0.8, stopwords: list[str] | None = None, use_idf: bool = False, seed: int = 1) -> Pipeline:
    """Tokenise, remove stopwords, count, (weigh,) and fit LDA online; raw counts unless ``use_idf``."""
    remover = StopWordsRemover(inputCol="raw", outputCol="words")
    if stopwords is not None:
        remover = remover.setStopWords(stopwords)
    stages = [
        RegexTokenizer(inputCol="body", outputCol="raw", pattern=r"[A-Za-z0-9\-]{3,50}", gaps=False, toLowercase=True),
        remover,
        CountVectorizer(inputCol="words", outputCol="features", vocabSize=vocabulary, minDF=min_df, maxDF=max_df, minTF=1),
    ]
    if use_idf:
        stages.append(IDF(inputCol="features", outputCol="idf"))
    lda = LDA(k=topics, maxIter=iterations, seed=seed, optimizer="online", learningOffset=100.0, learningDecay=0.51, featuresCol="idf" if use_idf else "features")
    return Pipeline(stages=[*stages, lda])


def describe(model: PipelineModel, words: int = 15) -> DataFrame:
    """(topic from 1, rank, word, weight)."""
    vocabulary = next(s.vocabulary for s in model.stages if hasattr(s, "vocabulary"))
    names = F.array(*[F.lit(w) for w in vocabulary])
    rows = model.stages[-1].describeTopics(words).select((F.col("topic") + 1).alias("topic"), F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "t"))
    return rows.select("topic", (F.col("rank") + 1).alias("rank"), F.element_at(names, F.col("t.termIndices") + 1).alias("word"), F.col("t.termWeights").alias("weight"))


def distributions(model: PipelineModel, docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, t1..tk, and the dominant topic (from 1; ties: the lowest)."""
    k = model.stages[-1].getK() if hasattr(model.stages[-1], "getK") else model.stages[-1].describeTopics(1).count()
    out = model.transform(docs).withColumn("d", vector_to_array("topicDistribution"))
    return out.select(*keep, *[F.col("d")[i].alias(f"t{i + 1}") for i in range(k)], F.array_position("d", F.array_max("d")).cast("int").alias("dominant"))


def topic_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c[0] == "t" and c[1:].isdigit()]


def means(topics: DataFrame, by: list[str]) -> DataFrame:
    """numArticles, source sums and the mean of every topic."""
    sums = [F.sum(c).alias(c) for c in ("sourcesFemaleCount", "sourcesMaleCount") if c in topics.columns]
    return topics.groupBy(*by).agg(F.count("*").alias("numArticles"), *sums, *[F.avg(c).alias(c) for c in topic_columns(topics)])


def with_dominance(topics: DataFrame, delta: int = 1) -> DataFrame:
    return topics.withColumn("cohort", dominance(delta)).where("cohort is not null")


def gender_difference(topics: DataFrame, delta: int = 1, by_outlet: bool = False) -> DataFrame:
    """(topic, [outlet,] female, male, diff): mean prominence by dominant source gender; absent cohorts are null."""
    by = ["outlet", "cohort"] if by_outlet else ["cohort"]
    wide = means(with_dominance(topics, delta), by)
    long = wide.unpivot(by, topic_columns(topics), "topic", "mean")
    keys = [c for c in by if c != "cohort"] + ["topic"]
    out = long.groupBy(*keys).pivot("cohort", ["female", "male"]).agg(F.first("mean"))
    return out.withColumn("diff", F.col("female") - F.col("male")).withColumn("topic", F.substring("topic", 2, 9).cast("int"))


def top_by_topic(topics: DataFrame, topic: int, n: int = 200, key: str = "_id") -> DataFrame:
    return topics.orderBy(F.desc(f"t{topic}"), key).limit(n)


def outlet_matrix(means_by_outlet: DataFrame) -> DataFrame:
    """(outlet, topic, mean) in long form."""
    return means_by_outlet.unpivot(["outlet"], topic_columns(means_by_outlet), "topic", "mean")

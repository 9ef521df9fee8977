"""Queries pN_ of this subpackage and the SQL beside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsweft.llm.names import found

    return found(_t(spark, sf_dir, "articles"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsweft.llm.near_duplicates import found

    return found(_t(spark, sf_dir, "articles"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsweft.llm.sentences import found

    return found(_t(spark, sf_dir, "articles"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsweft.llm.lookalike import found

    return found(_t(spark, sf_dir, "articles"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsweft.llm.repeated_lines import found

    return found(_t(spark, sf_dir, "articles"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsweft.llm.boilerplate import found

    return found(_t(spark, sf_dir, "articles"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsweft.llm.tokenize import encode_corpus

    return encode_corpus(_t(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsweft.llm.leakage import leaked_items

    return leaked_items(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsweft.llm.toxicity import found

    return found(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "content_labels"))


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsweft.llm.toxicity import source_rates

    return source_rates(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "content_labels"))


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "articles").select("_id", "outlet", "body").dropDuplicates(["_id"])


def p1_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name with its cluster."""
    from newsweft.llm.names import distinct_names, name_clusters
    from newsweft.session import cut_lineage

    return name_clusters(cut_lineage(distinct_names(_t(spark, sf_dir, "articles"))))


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every story with its class and number of links."""
    from newsweft.llm.near_duplicates import near_duplicate_classes

    return near_duplicate_classes(_t(spark, sf_dir, "articles"))


def p4_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every body in one consistent form."""
    from newsweft.llm.lookalike import canonicalise

    return canonicalise(_bodies(spark, sf_dir).select("_id", "body"), "body")


def p5_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every body without the lines its outlet repeats."""
    from newsweft.llm.repeated_lines import remove_repeated_lines

    return remove_repeated_lines(_bodies(spark, sf_dir)).select("_id", "body")


def p7_story(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the story of every body."""
    from newsweft.llm.boilerplate import main_text

    return main_text(_bodies(spark, sf_dir)).select("_id", "body")


def p7_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines each level of the style tree removes, by presentation."""
    from newsweft.llm.boilerplate import cuts_by_level

    return cuts_by_level(_t(spark, sf_dir, "articles"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p1_clusters": p1_clusters, "p2_classes": p2_classes, "p4_text": p4_text, "p5_clean": p5_clean, "p7_story": p7_story, "p7_reasons": p7_reasons, "p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p5_found": p5_found, "p7_found": p7_found, "p8_ids": p8_ids, "p9_found": p9_found, "p10_found": p10_found, "p10_rates": p10_rates}


def oracle_sql() -> dict[str, str]:
    return {}

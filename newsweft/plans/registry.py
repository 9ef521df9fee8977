"""Every query of the core by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsweft.operators import timestamps
from newsweft.plans import article_queries, order_queries
from newsweft.sources.tables import table


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestamps.found(table(spark, sf_dir, "articles"), table(spark, sf_dir, "outlets"))


def p6_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many texts are exact, and why the others have no instant."""
    return timestamps.normalise_timestamps(table(spark, sf_dir, "articles"), table(spark, sf_dir, "outlets")).groupBy("status").count()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**article_queries.SPARK, **order_queries.SPARK, "p6_found": p6_found, "p6_status": p6_status}


def oracle_sql() -> dict[str, str]:
    return {**article_queries.SQL, **order_queries.SQL}

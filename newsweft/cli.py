"""Statistics from the command line: every chosen query becomes a CSV folder.

    python -m newsweft.cli --articles PATH --out DIR --begin_date 2021-01-01 --end_date 2021-01-31 --outlet_stats
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from newsweft.operators import predicates as pr, stats
from newsweft.sources.files import write_csv

QUERIES: dict[str, Callable[[DataFrame, argparse.Namespace], DataFrame]] = {
    "db_stats": lambda a, o: stats.totals(a),
    "outlet_stats": lambda a, o: stats.totals(a, by=["outlet"]),
    "top_sources_female": lambda a, o: stats.top_sources(a, ["sourcesFemale"], o.limit, o.sort == "asc"),
    "top_sources_male": lambda a, o: stats.top_sources(a, ["sourcesMale"], o.limit, o.sort == "asc"),
    "top_sources_unknown": lambda a, o: stats.top_sources(a, ["sourcesUnknown"], o.limit, o.sort == "asc"),
    "top_sources_all": lambda a, o: stats.top_sources(a, ["sourcesFemale", "sourcesMale"], o.limit, o.sort == "asc"),
    **{f"{c}_author_sources": (lambda name: lambda a, o: stats.source_totals(a.where(pr.author_cohort(name)), ["outlet"]))(c) for c in pr.COHORTS},
    "daily_article_counts": lambda a, o: stats.daily_counts(a),
}


def condition(options: argparse.Namespace, name: str) -> Column:
    """Daily counts take every article of the outlets and days; the others need a body and annotations."""
    out = pr.days(options.begin_date, options.end_date)
    if options.outlets:
        out = out & pr.in_outlets(options.outlets.split(","))
    return out if name == "daily_article_counts" else out & pr.body_not_empty() & pr.is_annotated()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--articles", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--begin_date", required=True)
    p.add_argument("--end_date", required=True)
    p.add_argument("--outlets", default="")
    p.add_argument("--limit", type=int, default=100)
    p.add_argument("--sort", choices=["asc", "desc"], default="desc")
    for name in QUERIES:
        p.add_argument(f"--{name}", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[str]:
    options = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("newsweft").getOrCreate()
    articles, written = spark.read.parquet(options.articles), []
    for name, query in QUERIES.items():
        if getattr(options, name):
            path = f"{options.out}/{name}_{options.begin_date}_to_{options.end_date}"
            write_csv(query(articles.where(condition(options, name)), options), path)
            written.append(path)
    return written


if __name__ == "__main__":
    main()

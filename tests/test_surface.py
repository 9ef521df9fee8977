"""Entry points: command line, driver contract, ingest and single-text analysis."""

import datetime as dt
from pathlib import Path

import pytest

from newsweft import cli
from newsweft.functions import dates
from newsweft.operators import analyzer, ingest

COLUMNS = "_id int, publishedAt timestamp, outlet string, body string, quotesUpdated array<string>, quoteCount int, sourcesFemale array<string>, sourcesMale array<string>, sourcesUnknown array<string>, " + ", ".join(f"{k}{g}Count int" for k in ("people", "sources", "authors") for g in ("Female", "Male", "Unknown"))


def test_cli(spark, tmp_path):
    row = lambda i, day, body: (i, dt.datetime(2021, 1, day), "a", body, [], 1, ["Ann"], [], None, 1, 0, 0, 1, 0, 0, 1, 0, 0)
    spark.createDataFrame([row(1, 1, "x"), row(2, 2, ""), row(3, 31, None)], COLUMNS).write.parquet(str(tmp_path / "articles"))
    args = ["--articles", str(tmp_path / "articles"), "--out", str(tmp_path / "out"), "--begin_date", "2021-01-01", "--end_date", "2021-01-31", "--db_stats", "--top_sources_female", "--female_author_sources", "--daily_article_counts"]
    paths = cli.main(args, spark)
    assert len(paths) == 4
    got = {Path(p).name.split("_2021")[0]: spark.read.csv(p, header=True).collect() for p in paths}
    assert got["db_stats"][0].totalArticles == "2" and got["top_sources_female"][0][:] == ("Ann", "2")
    assert len(got["daily_article_counts"]) == 3 and got["female_author_sources"][0].totalFemaleSources == "2"


def test_ingest(spark):
    known = spark.createDataFrame([("http://www.x.example/a/",)], "url string")
    pages = spark.createDataFrame([("https://x.example/a?q=1", "b"), ("x.example/b", "b"), ("https://www.x.example/b#c", "b"), ("x.example/c", " ")], "url string, body string")
    assert {r.url for r in ingest.new_articles(pages, known).collect()} <= {"x.example/b", "https://www.x.example/b#c", "x.example/c"}
    assert ingest.new_articles(pages, known).count() == 2
    assert {r.status: r.n for r in ingest.tally(ingest.classify(pages, known, known.limit(0))).collect()} == {"URL Present": 1, "Inserted": 2, "Invalid Body": 1}


def test_dates():
    assert dates.month_end(dt.date(2021, 12, 1)) == dt.date(2022, 1, 1)
    assert dates.week_bound(2021, 52, 0) == dt.date(2021, 12, 26) and dates.week_bound(2021, 52, 6) == dt.date(2022, 1, 1)
    assert dates.default_month(dt.date(2021, 1, 20)) == (2020, 12)


def test_analyzer(spark):
    cache = spark.createDataFrame([("ann lee", "female")], "key string, gender string")
    texts = spark.createDataFrame([(1, 'Ann Lee met Bob Roy. According to Bob Roy, the bridge is closed for good.'), (2, None), (3, "x" * 30000)], "_id int, body string")
    said, table = analyzer.analyze(texts, [cache], [])
    assert said.count() == 1
    got = {(r.role, r.gender): r.names for r in table.collect()}
    assert got[("people", "female")] == "Ann Lee" and got[("sources", "unknown")] == "Bob Roy"
    assert {r.role for r in analyzer.pie_counts(table).collect()} == {"people", "sources"}


def test_driver_contract():
    entry = pytest.importorskip("__spark_entry__")
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and "p6_found" in names
    assert all(isinstance(v, str) for v in entry.oracle_sql().values())

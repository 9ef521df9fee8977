import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsweft.functions import spans, text as tx, url as ux
from newsweft.operators import corpus, entities, evaluation, gender, predicates, quotes, serving, stats, topics, upsert


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_text_rules(spark):
    lit = F.lit
    assert value(spark, tx.clean_text_en(lit("Léa\u00a0said “hi”\nBye.\nEnd"))) == 'Lea said "hi".\n Bye.\n End'
    assert value(spark, tx.clean_text_fr(lit("l’été * fin. \n . suite"))) == "l'été   fin. \n   suite"
    assert value(spark, tx.clean_name(lit("  Justin   Trudeau’s "))) == "Justin Trudeau"
    assert value(spark, tx.accent_fold(lit("François ÉÇ"))) == "Francois EC"
    assert value(spark, tx.remove_titles(lit("Dr Ann Lee MBE"))) == "Ann Lee"
    assert value(spark, tx.name_length_is_invalid(lit("One")))
    assert value(spark, tx.name_length_is_invalid(lit("a b c d e f g")))
    assert value(spark, tx.first_name(lit("Ann Lee"))) == "Ann"
    assert value(spark, tx.first_name(lit("Ann"))) is None
    assert value(spark, tx.almost_same(lit("Marie"), lit("Mariee")))
    assert not value(spark, tx.almost_same(lit(""), lit("")))
    assert value(spark, tx.french_title_gender(lit("Mme la présidente"))) == "female"
    assert value(spark, tx.trim_marks(lit("« Ann »"))) == "Ann"
    assert value(spark, tx.topic_tokens(lit("A big-deal at 10th"))) == ["big-deal", "10th"]


def test_urls(spark):
    lit = F.lit
    assert value(spark, ux.canonical(lit("https://www.x.example/a/?q=1#f"))) == "https://www.x.example/a"
    assert set(value(spark, ux.spellings(lit("http://x.example/a")))) == {"http://x.example/a", "https://x.example/a", "http://www.x.example/a", "https://www.x.example/a"}
    assert value(spark, ux.article_type(lit("https://x.example/news/opinion/1"))) == "opinion"
    assert value(spark, ux.article_type(lit("https://x.example/opinionated"))) == "hard news"
    assert value(spark, ux.article_type(lit(""))) == "unknown"
    assert value(spark, ux.admitted(lit("https://m.x.example/a"), lit("www.x.example")))
    assert not value(spark, ux.admitted(lit("https://evilx.example/a"), lit("x.example")))


def test_spans(spark):
    lit = F.lit
    assert value(spark, spans.parse_span(lit("(12, 34)"))) == (12, 34)
    assert value(spark, spans.parse_span(lit(""))) is None
    assert not value(spark, spans.covers(lit(0), lit(5), lit(4), lit(9)))
    assert value(spark, spans.covers(lit(0), lit(5), lit(3), lit(9)))


def test_null_semantics(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "_id int, body string")
    assert {r[0] for r in df.where(predicates.body_not_empty()).collect()} == {1, 3}
    with pytest.raises(ValueError):
        predicates.check_window("2018-09-27", "2018-10-01", "2018-09-29", dt.date(2022, 1, 1))
    empty = spark.createDataFrame([], "quoteCount int, peopleFemaleCount int, peopleMaleCount int, peopleUnknownCount int")
    assert stats.totals(empty, ("people",)).count() == 0


def test_weeks(spark):
    days = spark.createDataFrame([(dt.datetime(2021, 12, 26), "a", 2, 1, 3, 0), (dt.datetime(2022, 1, 1), "a", 1, 0, 0, 0), (dt.datetime(2022, 1, 2), "a", 1, 0, 0, 0)], "publishedAt timestamp, outlet string, totalArticles long, totalFemales long, totalMales long, totalUnknowns long")
    rows = serving.weekly_info(days).orderBy("weekBegin").collect()
    assert [(str(r.weekBegin), str(r.weekEnd), r.totalArticles, r.perFemales) for r in rows] == [("2021-12-26", "2022-01-01", 3, 0.25), ("2022-01-02", "2022-01-08", 1, 0.0)]
    assert [str(r.week) for r in serving.weekly_counts(days).orderBy("week").collect()] == ["2021-12-26", "2022-01-02"]
    share = spark.createDataFrame([("a", dt.date(2022, 1, d), float(d)) for d in (1, 2, 3)] + [("b", dt.date(2022, 1, 1), 9.0)], "outlet string, day date, share double")
    assert [r.rolling for r in serving.rolling_share(share).orderBy("outlet", "day").collect()] == [1.0, 1.5, 2.0, 9.0]
    assert serving.rolling_share(share, legacy_unpartitioned=True).orderBy("outlet", "day").collect()[-1].rolling == 3.75


def test_days_without_sources(spark):
    """A day with articles but no source is undefined and left out; a day that is missing is 0."""
    day = lambda o, d, f, m: (dt.datetime(2022, 1, d), o, 3, f, m, 0)
    daily = spark.createDataFrame([day("a", 1, 1, 3), day("a", 2, 0, 0), day("a", 4, 2, 2), day("b", 5, 0, 0)], "publishedAt timestamp, outlet string, totalArticles long, totalFemales long, totalMales long, totalUnknowns long")
    got = {(r.outlet, r.day.day): r.share for r in serving.female_share(daily, fill=True).collect()}
    assert got == {("a", 1): 25.0, ("a", 3): 0.0, ("a", 4): 50.0, ("a", 5): 0.0, ("b", 1): 0.0, ("b", 2): 0.0, ("b", 3): 0.0, ("b", 4): 0.0}
    weeks = serving.weekly_counts(daily)
    assert [str(r.week) for r in serving.hide_future(weeks, F.lit("2022-01-08").cast("date")).where("outlet = 'a'").orderBy("week").collect()] == ["2022-01-02"]
    assert serving.display_names(weeks, {"a": "A"}).where("outlet = 'A'").count() == 2


def test_merge_of_english_names():
    from newsweft.operators.entities import mergeable, merged_names

    assert mergeable("Ann Lee", "Ann") and not mergeable("Ann Lee", "Lee") and not mergeable("ann lee", "ann")
    assert mergeable("Ann Mary Lee", "Lee") and mergeable("Mary Lee", "Ann Mary Lee") and not mergeable("Ann Mary Lee", "Ann Mary")
    assert merged_names(["Ann", "Bob Roy", "Ann Lee", "Roy", "Ann Mary Lee"]) == [("Bob Roy", ["Bob Roy"]), ("Ann Lee", ["Ann", "Ann Lee"]), ("Ann Mary Lee", ["Ann Mary Lee"])]


def test_nearest_verb_stays_in_its_sentence():
    inner = "one two three four five six seven"
    for text, verb in ((f'Ann said "{inner}" today', "said"), (f'Ann said so. It "{inner}" today', ""), (f'It "{inner}". He said', ""), (f'It "{inner}" he said', "said")):
        q = quotes.heuristic_quotes(text, quotes.default_tokens(text))
        assert [x["verb"] for x in q] == [verb]


def test_upserts(spark, tmp_path):
    old = spark.createDataFrame([("a", 1, "kept"), ("b", 2, "")], "_id string, n int, comment string")
    new = spark.createDataFrame([("a", 5, ""), ("c", 3, "")], "_id string, n int, comment string")
    once = upsert.upsert(old, new, ["_id"])
    assert sorted(upsert.upsert(once, new, ["_id"]).collect()) == sorted(once.collect())
    assert {(r[0], r[1], r[2]) for r in upsert.keep_comment(old, new).collect()} == {("a", 5, "kept"), ("b", 2, ""), ("c", 3, "")}
    path = str(tmp_path / "t")
    upsert.swap(old, path)
    upsert.swap(upsert.upsert(spark.read.parquet(path), new, ["_id"]), path)
    assert spark.read.parquet(path).count() == 3


def test_gender_cascade(spark):
    cache = spark.createDataFrame([("Ann Lee", "F"), ("ANN LEE", "unknown"), ("Bob Roy", "male"), ("Kim Ray", "male"), ("Kim Fox", "female"), ("X", None)], "name string, gender string")
    names = spark.createDataFrame([("Ánn Lee",), ("Bob Smith",), ("Kim Smith",), ("Bob",), ("Zed Roy",)], "name string")
    got = {r.name: r.gender for r in gender.cascade(names, [gender.name_cache(cache)], [gender.first_name_cache(cache)]).collect()}
    assert got == {"Ánn Lee": "female", "Bob Smith": "male", "Kim Smith": "unknown", "Bob": "unknown", "Zed Roy": "unknown"}


def test_entities(spark):
    rows = spark.createDataFrame([(1, ["Ann Lee", "Ann Lee of CBC", "Bob", "News Staff", None]), (2, None)], "_id int, authors array<string>")
    got = {r[0]: r[1] for r in rows.select("_id", entities.clean_authors(F.col("authors"), ["News"])).collect()}
    assert got == {1: ["Ann Lee"], 2: []}
    mentions = spark.createDataFrame([("d", "Ann Mary Lee", 0), ("d", "Mary Lee", 1), ("d", "Lee", 2), ("d", "Bob", 3)], "doc string, name string, seq int")
    assert {(r.name, r.entity) for r in entities.merge_names(mentions).collect()} == {("Ann Mary Lee", "Ann Mary Lee"), ("Mary Lee", "Ann Mary Lee"), ("Lee", "Ann Mary Lee")}
    assert entities.mergeable_fr("Valérie Plante", "Valerie Plante") and not entities.mergeable_fr("M Roy", "M Roy", "male", "female")
    quotes_ = spark.createDataFrame([("d", 0, 10, 20), ("d", 1, None, None)], "doc string, quote int, s_start int, s_end int")
    spots = spark.createDataFrame([("d", "B", 1, 18, 30), ("d", "A", 2, 10, 20), ("d", "C", 0, 19, 25)], "doc string, entity string, seq int, m_start int, m_end int")
    assert {(r.quote, r.entity) for r in entities.align_quotes(quotes_, spots).collect()} == {(0, "B"), (1, None)}


def tok(words, **deps):
    """Tokens of 'word/pos' with dep and head by index."""
    out, at = [], 0
    for i, w in enumerate(words):
        dep, head = deps.get(f"t{i}", ("", i))
        out.append({"i": i, "text": w, "lemma": w.lower(), "pos": "", "dep": dep, "head": head, "start": at, "end": at + len(w), "sent": 0, "ent": ""})
        at += len(w) + 1
    return " ".join(words), out


def test_syntactic_quotes():
    text, tokens = tok("Ann said taxes will rise soon".split(), t0=("nsubj", 1), t1=("ROOT", 1), t2=("nsubj", 4), t3=("aux", 4), t4=("ccomp", 1), t5=("advmod", 4))
    q = quotes.syntactic_quotes(text, tokens)[0]
    assert (q["speaker"], q["verb"], q["quote"], q["quote_type"]) == ("Ann", "said", "taxes will rise soon", "SVC")
    text, tokens = tok("We said taxes will rise".split(), t0=("nsubj", 1), t4=("ccomp", 1))
    assert quotes.syntactic_quotes(text, tokens) == []


def test_other_quotes():
    text = 'Ann Lee said "one two three four five six seven eight" today. According to Bob Roy, the bridge is closed for good.'
    tokens = quotes.default_tokens(text)
    got = quotes.english_quotes(text, tokens)
    assert [q["quote_type"] for q in got] == ["AccordingTo", "Heuristic"]
    assert got[1]["verb"] == "said" and got[0]["speaker"] == "Bob Roy"
    fr = "« Le pont est fermé pour toujours », affirme Léa Roy. Selon Luc Roy, le pont sera vendu cette année."
    tk = quotes.default_tokens(fr)
    assert quotes.guillemet_quotes(fr, tk)[0]["speaker"] == "Léa Roy"
    assert quotes.selon_quotes(fr, tk)[0]["speaker"] == "Luc Roy"
    overlapping = [quotes.make("a b c d e f", (0, 9), None, None, 5, "x"), quotes.make("a b c d e f", (2, 11), None, None, 5, "x"), quotes.make("a b c d e f", (0, 3), None, None, 2, "x")]
    assert len(quotes.drop_overlaps(overlapping)) == 1


def test_evaluation(spark):
    cols = "doc string, q_start int, q_end int, s_start int, s_end int, v_start int, v_end int, floating boolean"
    gold = spark.createDataFrame([("d", 0, 10, 12, 15, 16, 20, False), ("d", 30, 40, None, None, None, None, False)], cols)
    pred = spark.createDataFrame([("d", 0, 3, 12, 15, 16, 20, False), ("d", 30, 39, None, None, None, None, True)], cols)
    r = evaluation.match_quotes(gold, pred, 0.3).first()
    assert (r.targets, r.predictions, r.matched, r.speakers, r.verbs) == (2, 2, 1, 1, 1)  # exactly 0.3 is no match
    assert evaluation.quote_metrics(evaluation.match_quotes(gold, pred, 0.2)).first().f1 == 1.0
    lists = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], [])], "g array<string>, p array<string>")
    assert evaluation.list_metrics(lists, "g", "p").first()["tp"] == 1


def test_corpus_and_topics(spark):
    docs = spark.createDataFrame([(1, "tax tax road"), (2, "road bridge")], "id int, text string")
    rows = corpus.tokens(docs, "id", "text")
    assert {(r.word, r.n) for r in corpus.frequencies(rows).collect()} == {("tax", 2), ("road", 2), ("bridge", 1)}
    assert {(r.word, r.docs) for r in corpus.document_range(rows, "id").collect()} == {("tax", 1), ("road", 2), ("bridge", 1)}
    t = spark.createDataFrame([("a", 2, 0, 0.5, 0.5), ("a", 0, 3, 0.1, 0.9), ("b", 1, 1, 0.3, 0.7)], "outlet string, sourcesFemaleCount int, sourcesMaleCount int, t1 double, t2 double")
    diff = {r.topic: round(r["diff"], 6) for r in topics.gender_difference(t).collect()}
    assert diff == {1: 0.4, 2: -0.4}


def test_streaming_daily(spark, tmp_path):
    from newsweft.streaming.daily import daily_stream, write_daily

    cols = "publishedAt timestamp, outlet string, body string, sourcesFemaleCount int, sourcesMaleCount int, sourcesUnknownCount int"
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(dt.datetime(2022, 1, 1, 5), "a", "x", 1, 0, None), (dt.datetime(2022, 1, 1, 6), "a", "", 1, 0, 0)], cols).write.parquet(src)
    write_daily(daily_stream(spark.readStream.schema(cols).parquet(src)), out, str(tmp_path / "c")).awaitTermination(120)
    spark.createDataFrame([(dt.datetime(2022, 1, 1, 7), "a", "x", 0, 2, 0)], cols).write.mode("append").parquet(src)
    write_daily(daily_stream(spark.readStream.schema(cols).parquet(src)), out, str(tmp_path / "c")).awaitTermination(120)
    r = spark.read.parquet(out).collect()
    assert [(str(x.day), x.totalArticles, x.totalFemales, x.totalMales) for x in r] == [("2022-01-01", 2, 1, 2)]


def test_files(spark, tmp_path):
    from newsweft.sources import files

    (tmp_path / "lem").write_text("go -> goes went\nrun -> went\nx\n")
    assert {(r.form, r.lemma) for r in files.lemma_table(spark, str(tmp_path / "lem")).collect()} == {("goes", "go"), ("went", "go")}
    (tmp_path / "al").write_text("primary,aliases\nAnn Lee, A. Lee, Annie Lee\n")
    assert files.alias_table(spark, str(tmp_path / "al")).count() == 2
    (tmp_path / "r.jsonl").write_text('{"label": "PERSON", "pattern": "Ann"}\n{"label": "ORG", "pattern": [{"LOWER": "big"}, {"ORTH": "Co"}]}\n')
    assert {r.phrase for r in files.name_rules(spark, str(tmp_path / "r.jsonl")).collect()} == {"Ann", "big Co"}
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts" / "12.en.txt").write_text("body\nmore")
    assert files.folder_texts(spark, str(tmp_path / "texts")).first() == ("12", "body\nmore")
    pages = spark.createDataFrame([(1, '<a href="/x">x</a><script type="application/ld+json">{"a":1}</script>')], "page_id int, html string")
    assert files.ld_json(pages).first().json == '{"a":1}' and files.links(pages).first().url == "/x"


def test_topic_queries_fit_the_production_model(spark):
    from newsweft.plans import order_queries

    model = order_queries._lda(spark, "/root/testdata/sf0.001")[0].stages[-1]
    assert (model.getK(), model.getMaxIter()) == (15, 150)

"""Queries over the project's own tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsweft.functions import dates, text as tx, url as ux
from newsweft.operators import analyzer, corpus, entities, evaluation, gender, ingest, predicates as pr, quotes, serving, stats, upsert
from newsweft.operators.predicates import COHORTS
from newsweft.sources.tables import table

BLOCKLIST = "News Staff Reporter Newsroom Rédaction Columnist".split()
#: Spellings of prolific sources and the primary form they are counted under.
ALIASES = [("Nadia Jususerinus", "N. Jususerinus"), ("Richard Mitutezabri", "R. Mitutezabri"), ("Moosehead Granite Fisheries Corporation", "Moosehead Fisheries")]

COUNTS = [f"{k}{g}Count" for k in ("people", "sources") for g in ("Female", "Male", "Unknown")]
LATEST = "art AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY lastModified DESC NULLS LAST) AS rn FROM articles) WHERE rn = 1)"
BASE = f"WITH {LATEST}, ok AS (SELECT * FROM art WHERE body IS DISTINCT FROM '' AND quotesUpdated IS NOT NULL)"
ACC, PLAIN = tx.ACCENTED, tx.PLAIN


def _ok(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Latest deliveries with a body and annotations; the filter columns do not travel."""
    a = table(spark, d, "articles").select("_id", "lastModified", *columns, (~F.col("body").eqNullSafe("") & F.col("quotesUpdated").isNotNull()).alias("ok"))
    return stats.latest(a, *columns, "ok").where("ok").drop("ok")


def _one(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return stats.latest(table(spark, d, "articles").select("_id", "lastModified", *columns), *columns)


def _genders(spark: SparkSession, d: str, names: DataFrame) -> DataFrame:
    cache = table(spark, d, "gender_cache").where("name is not null")
    return gender.cascade(names, [gender.name_cache(cache)], [gender.first_name_cache(cache)])


_G = "CASE WHEN lower(trim(gender)) IN ('female','f') THEN 'female' WHEN lower(trim(gender)) IN ('male','m') THEN 'male' END"
_K = f"lower(translate(replace(name, chr(160), ' '), '{ACC}', '{PLAIN}'))"
_TOK = "list_filter(regexp_split_to_array(trim({x}), '\\s+'), lambda w: w <> '')"
CACHE = (
    f"cache AS (SELECT {_K} AS k, {_G} AS g FROM gender_cache WHERE name IS NOT NULL), "
    "full_c AS (SELECT k, min(g) AS g FROM cache WHERE g IS NOT NULL GROUP BY 1), "
    f"first_c AS (SELECT f, min(g) AS g FROM (SELECT CASE WHEN contains(trim(k), ' ') THEN {_TOK.format(x='k')}[1] END AS f, g FROM cache WHERE g IS NOT NULL) WHERE f IS NOT NULL GROUP BY 1 HAVING min(g) = max(g))"
)
CASCADE = (
    f"keyed AS (SELECT name, {_K} AS k FROM names), "
    f"resolved AS (SELECT name, CASE WHEN len({_TOK.format(x='name')}) <= 1 OR len({_TOK.format(x='name')}) > 6 THEN 'unknown' ELSE coalesce(c.g, f.g, 'unknown') END AS gender "
    f"FROM keyed LEFT JOIN full_c c ON keyed.k = c.k LEFT JOIN first_c f ON CASE WHEN contains(trim(keyed.k), ' ') THEN {_TOK.format(x='keyed.k')}[1] END = f.f)"
)


def _sum_sql(kinds: tuple[str, ...]) -> str:
    return ", ".join(f"coalesce(sum({k}{g}Count), 0)::BIGINT AS {k}{g}Count" for k in kinds for g in ("Female", "Male", "Unknown"))


def db_stats(spark, d):
    return stats.totals(_ok(spark, d, "quoteCount", *COUNTS), ("people", "sources"))


def outlet_stats(spark, d):
    return stats.totals(_ok(spark, d, "outlet", "quoteCount", *COUNTS), ("people", "sources"), ["outlet"])


def _top(fields, limit=100, ascending=False):
    return lambda spark, d: stats.top_sources(_ok(spark, d, *fields), fields, limit, ascending)


def _top_sql(fields, limit=100, direction="DESC"):
    names = " || ".join(f"coalesce({f}, [])" for f in fields)
    return f"{BASE} SELECT name, count(*) AS count FROM (SELECT unnest({names}) AS name FROM ok) GROUP BY 1 ORDER BY 2 {direction}, 1 LIMIT {limit}"


def _author_rows(spark, d):
    rows = _ok(spark, d, "outlet", "authors", "sourcesMaleCount", "sourcesFemaleCount", "sourcesUnknownCount")
    names = rows.select(F.explode("authors").alias("name")).where("name <> ''").distinct()
    g = _genders(spark, d, names)
    per = rows.select("_id", F.explode(F.array_distinct("authors")).alias("name")).join(g, "name").groupBy("_id").agg(*[F.sum((F.col("gender") == x).cast("int")).alias(f"authors{x.capitalize()}Count") for x in ("female", "male", "unknown")])
    return rows.join(per, "_id")


def _cohort(name):
    return lambda spark, d: stats.source_totals(_author_rows(spark, d).where(COHORTS[name].format(f="authorsFemaleCount", m="authorsMaleCount")), ["outlet"])


def _cohort_sql(name):
    return (
        f"{BASE}, names AS (SELECT DISTINCT name FROM (SELECT unnest(authors) AS name FROM ok) WHERE name <> ''), {CACHE}, {CASCADE}, "
        "per AS (SELECT _id, count(*) FILTER (gender='female') AS f, count(*) FILTER (gender='male') AS m FROM (SELECT DISTINCT _id, unnest(authors) AS name FROM ok) JOIN resolved USING (name) GROUP BY 1) "
        "SELECT outlet, count(*) AS totalArticles, coalesce(sum(sourcesMaleCount),0)::BIGINT AS totalMaleSources, coalesce(sum(sourcesFemaleCount),0)::BIGINT AS totalFemaleSources, coalesce(sum(sourcesUnknownCount),0)::BIGINT AS totalUnknownSources "
        f"FROM ok JOIN per USING (_id) WHERE {COHORTS[name].format(f='f', m='m')} GROUP BY 1"
    )


def gender_cascade(spark, d):
    names = _one(spark, d, "people").select(F.explode("people").alias("name")).distinct()
    return _genders(spark, d, names)


def people_by_gender(spark, d):
    rows = _one(spark, d, "people")
    names = rows.select(F.explode("people").alias("name")).distinct()
    return gender.people_by_gender(rows, _genders(spark, d, names))


def author_dedup(spark, d):
    return _one(spark, d, "authors").where("authors is not null").select("_id", F.array_join(F.array_sort(entities.dedupe_authors(F.filter("authors", lambda a: a != ""))), "; ").alias("kept"))


def author_clean(spark, d):
    return _one(spark, d, "authors").select("_id", F.array_join(F.array_sort(entities.clean_authors(F.col("authors"), BLOCKLIST)), "; ").alias("authors"))


_CN = "trim(regexp_replace(regexp_replace(trim(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_]', ' ', 'g')), ' s$', ''), '\\s+', ' ', 'g'))"


def url_canonical(spark, d):
    u = table(spark, d, "articles").where("url is not null").select("url").distinct()
    return u.select("url", ux.canonical(F.col("url")).alias("canonical"), ux.identity(F.col("url")).alias("identity"), ux.host(F.col("url")).alias("host"))


_CANON = "regexp_replace(regexp_replace(trim(url), '[?#].*$', ''), '/$', '')"
_IDENT = f"regexp_replace(regexp_replace({_CANON}, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^www\\.', '')"
_HOST = "lower(regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#:]+)', 1))"
_PATH = "regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]+(/[^?#]*)?', 1)"


def url_first_seen(spark, d):
    rows = table(spark, d, "articles").where("url is not null").select(ux.identity(F.col("url")).alias("identity"), "lastModified")
    return rows.groupBy("identity").agg(F.date_format(F.min("lastModified"), "yyyy-MM-dd HH:mm:ss").alias("firstSeen"), F.count("*").alias("deliveries"))


def article_type(spark, d):
    return _one(spark, d, "url").select("_id", ux.article_type(F.col("url")).alias("type"))


def url_admission(spark, d):
    domains = table(spark, d, "outlets").select("outlet", "domain")
    rows = _one(spark, d, "url", "outlet").join(domains, "outlet", "left")
    return rows.select("_id", ux.admitted(F.col("url"), F.col("domain"), ["blogs"], ["/actualites/"]).alias("admitted"))


def url_variants(spark, d):
    rows = _one(spark, d, "url").where("url is not null")
    return rows.select("_id", F.explode(ux.spellings(F.col("url"))).alias("spelling"))


def clean_text_en(spark, d):
    return _one(spark, d, "title").where("title is not null").select("_id", tx.clean_text_en(F.col("title")).alias("title"), tx.accent_fold(F.col("title")).alias("folded"))


def clean_text_fr(spark, d):
    return _one(spark, d, "title").where("title is not null").select("_id", tx.clean_text_fr(F.col("title")).alias("title"))


def clean_names(spark, d):
    n = _one(spark, d, "people").select(F.explode("people").alias("name")).distinct()
    c = F.col("name")
    return n.select("name", tx.clean_name(c).alias("clean"), tx.name_length_is_invalid(c).alias("invalid"), tx.first_name(c).alias("first"), tx.contains_digit(c).alias("digit"))


def name_near_cache(spark, d):
    """Cache entries that are the same name but for one letter."""
    n = table(spark, d, "gender_cache").where("name is not null").select(F.regexp_replace(F.lower(tx.accent_fold(F.col("name"))), "[^ -~]", "").alias("a")).where("a <> ''").distinct()
    # two names at one edit are equal after one letter, or none, is taken out of each
    without = F.transform(F.sequence(F.lit(1), F.length("a")), lambda k: F.concat(F.substring(F.col("a"), F.lit(1), k - 1), F.substring(F.col("a"), k + 1, F.length("a"))))
    keyed = n.select("a", F.explode(F.array_distinct(F.concat(F.array("a"), without))).alias("k"))
    pairs = keyed.join(keyed.withColumnRenamed("a", "b"), "k").where("a < b").select("a", "b").distinct()
    return pairs.where(tx.almost_same(F.col("a"), F.col("b"), 1)).select("a", "b")


def _daily(spark, d):
    return table(spark, d, "media_daily")


_SHARES = "totalArticles, totalFemales, totalMales, totalUnknowns, totalFemales+totalMales+totalUnknowns AS totalGenders, " + ", ".join(
    f"CASE WHEN totalFemales+totalMales+totalUnknowns = 0 THEN 0.0 ELSE round(total{g}s::DOUBLE/(totalFemales+totalMales+totalUnknowns), 6) END AS per{g}s" for g in ("Female", "Male", "Unknown")
)
_SUMS = "coalesce(sum(totalArticles),0)::BIGINT AS totalArticles, coalesce(sum(totalFemales),0)::BIGINT AS totalFemales, coalesce(sum(totalMales),0)::BIGINT AS totalMales, coalesce(sum(totalUnknowns),0)::BIGINT AS totalUnknowns"


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(c, 6))
    return df


_PER = ("perFemales", "perMales", "perUnknowns")


def info_by_date_outlet(spark, d):
    return _rounded(serving.info_by_date(_daily(spark, d)), *_PER, "perArticles")


def info_by_date_total(spark, d):
    return _rounded(serving.info_total(_daily(spark, d)), *_PER)


def weekly_info(spark, d):
    return _rounded(serving.weekly_info(_daily(spark, d)), *_PER)


def weekly_article_counts_filled(spark, d):
    return serving.weekly_counts(_daily(spark, d).where("outlet is not null"))


def daily_female_share(spark, d):
    return _rounded(serving.female_share(_daily(spark, d)), "share")


def daily_female_share_filled(spark, d):
    return _rounded(serving.female_share(_daily(spark, d).where("outlet is not null"), fill=True), "share")


def daily_female_share_rolling7(spark, d):
    return _rounded(serving.rolling_share(serving.female_share(_daily(spark, d).where("outlet is not null"), fill=True)), "share", "rolling")


def daily_female_share_trend(spark, d):
    return _rounded(serving.trend(serving.female_share(_daily(spark, d))), "slope").withColumn("intercept", F.round("intercept", 3))


_SHARE = "sh AS (SELECT outlet, day, 100.0*f/(f+m+u) AS share FROM (SELECT outlet, (publishedAt AT TIME ZONE 'UTC')::DATE AS day, sum(totalFemales) f, sum(totalMales) m, sum(totalUnknowns) u FROM media_daily WHERE {w} GROUP BY 1,2) WHERE f+m+u > 0)"
#: Days that are there without any source are undefined and dropped; days that are not there are 0.
_DAYS = "dd AS (SELECT outlet, (publishedAt AT TIME ZONE 'UTC')::DATE AS day, sum(totalFemales) f, sum(totalMales) m, sum(totalUnknowns) u FROM media_daily WHERE outlet IS NOT NULL GROUP BY 1,2)"
_FILLED = _DAYS + ", grid AS (SELECT o.outlet, g.day FROM (SELECT DISTINCT outlet FROM dd) o, (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM dd) g), fil AS (SELECT g.outlet, g.day, CASE WHEN d.day IS NULL THEN 0.0 ELSE 100.0*f/(f+m+u) END AS share FROM grid g LEFT JOIN dd d ON g.outlet = d.outlet AND g.day = d.day WHERE d.day IS NULL OR f+m+u > 0)"


def alias_merged_top_sources(spark, d):
    aliases = spark.createDataFrame([(a, p) for p, a in ALIASES], "alias string, primary string")
    rows = _ok(spark, d, "sourcesFemale", "sourcesMale")
    parts = [rows.select(F.explode(f"sources{g}").alias("name")).groupBy("name").agg(F.count("*").alias("count")).withColumn("gender", F.lit(g.lower())) for g in ("Female", "Male")]
    merged = serving.alias_merge(parts[0].unionByName(parts[1]), F.broadcast(aliases), ["gender"])
    return serving.top_per_group(merged, "gender", 15).select("gender", "name", "count", "rank")


def quote_type_shares(spark, d):
    rows = _ok(spark, d, "quotesUpdated").select(F.explode("quotesUpdated").alias("q")).select(F.col("q.quote_type").alias("quote_type"))
    return quotes.type_shares(rows)


def quote_spans(spark, d):
    """Lengths of quotes and speakers from the encoded spans, by type."""
    rows = entities.quote_rows(_ok(spark, d, "quotesUpdated"))
    return rows.groupBy("quote_type").agg(F.count("*").alias("n"), F.sum((F.col("t.end") - F.col("t.start")).cast("long")).alias("quote_chars"), F.sum((F.col("s.end") - F.col("s.start")).cast("long")).alias("speaker_chars"), F.sum(F.col("s").isNull().cast("long")).alias("no_speaker"))


def speaker_alignment(spark, d):
    """Quotes aligned with the first entity, by name order, whose speaker spans share two characters with theirs."""
    rows = entities.quote_rows(_ok(spark, d, "quotesUpdated"))
    q = rows.select("doc", "quote", F.col("s.start").alias("s_start"), F.col("s.end").alias("s_end"))
    m = rows.where("speaker <> ''").select("doc", F.col("speaker").alias("entity"), F.col("speaker").alias("seq"), F.col("s.start").alias("m_start"), F.col("s.end").alias("m_end"))
    return entities.align_quotes(q, m)


def floating_reference(spark, d):
    rows = entities.quote_rows(_ok(spark, d, "quotesUpdated")).select("doc", "quote", "speaker", F.col("t.start").alias("q_start"))
    return entities.floating_reference(rows.withColumn("speaker", F.when(F.col("quote") % 3 == 2, "").otherwise(F.col("speaker")))).select("doc", "quote", "reference")


_QROWS = BASE + ", q AS (SELECT _id AS doc, i - 1 AS quote, quotesUpdated[i] AS q FROM (SELECT _id, quotesUpdated, unnest(range(1, len(quotesUpdated) + 1)) AS i FROM ok)), sp AS (SELECT doc, quote, q.speaker AS speaker, q.quote_type AS quote_type, try_cast(nullif(regexp_extract(q.speaker_index, '^\\((\\d+), ?(\\d+)\\)$', 1), '') AS INT) AS s1, try_cast(nullif(regexp_extract(q.speaker_index, '^\\((\\d+), ?(\\d+)\\)$', 2), '') AS INT) AS s2, try_cast(nullif(regexp_extract(q.quote_index, '^\\((\\d+), ?(\\d+)\\)$', 1), '') AS INT) AS t1, try_cast(nullif(regexp_extract(q.quote_index, '^\\((\\d+), ?(\\d+)\\)$', 2), '') AS INT) AS t2 FROM q)"


def list_eval_metrics(spark, d):
    """Sources as annotated against people as annotated, by outlet."""
    rows = _ok(spark, d, "outlet", "people", "sources")
    return evaluation.list_metrics(rows, "people", "sources", ["outlet"])


def gender_ratio(spark, d):
    rows = _ok(spark, d, "outlet", *COUNTS)
    return evaluation.gender_ratio(rows, F.col("sourcesFemaleCount"), F.col("sourcesMaleCount"), F.col("sourcesUnknownCount"), ["outlet"])


def quote_eval_metrics(spark, d):
    """Greedy matching of updated against original quotes at overlap 0.3."""
    a = _ok(spark, d, "quotes", "quotesUpdated")
    span = lambda f: entities.quote_rows(a, f).select("doc", F.col("t.start").alias("q_start"), F.col("t.end").alias("q_end"), F.col("s.start").alias("s_start"), F.col("s.end").alias("s_end"), F.col("v.start").alias("v_start"), F.col("v.end").alias("v_end"), F.coalesce("floating", F.lit(False)).alias("floating"))
    return evaluation.quote_metrics(evaluation.match_quotes(span("quotesUpdated"), span("quotes"), 0.3))


def heuristic_quotes(spark, d):
    found = quotes.extract(_one(spark, d, "body"), quotes.heuristic_quotes)
    return found.select("_id", F.explode("quotes").alias("q")).select("_id", "q.quote", "q.verb", "q.quote_token_count")


def english_quotes(spark, d):
    found = quotes.extract(_one(spark, d, "body"), quotes.english_quotes)
    return found.select("_id", F.explode("quotes").alias("q")).select("_id", "q.quote", "q.quote_type", "q.speaker")


def guillemet_quotes(spark, d):
    found = quotes.extract(_one(spark, d, "body"), quotes.guillemet_quotes)
    return found.select("_id", F.explode("quotes").alias("q")).select("_id", "q.quote", "q.quote_type", "q.speaker")


def selon_quotes(spark, d):
    found = quotes.extract(_one(spark, d, "body"), quotes.selon_quotes)
    return found.select("_id", F.explode("quotes").alias("q")).select("_id", "q.quote", "q.speaker")


def quote_stats_summary(spark, d):
    """Statistics of per-article counters of the annotations."""
    a = _ok(spark, d, "quotesUpdated", "quoteCount", "speakersNotCountedInSources")
    n = lambda cond: F.size(F.filter("quotesUpdated", cond))
    rows = a.select(F.size("quotesUpdated").alias("quotes"), n(lambda q: q["speaker"] == "").alias("speakerless"), n(lambda q: q["verb"] == "").alias("verbless"), n(lambda q: q["is_floating_quote"]).alias("floating"), F.coalesce("speakersNotCountedInSources", F.lit(0)).alias("not_counted"))
    return _rounded(quotes.summary(rows, ["quotes", "speakerless", "verbless", "floating", "not_counted"], "quotes"), "total", "mean", "median", "std", "share")


def _words(spark, d):
    docs = table(spark, d, "documents").where("text is not null").dropDuplicates(["doc_id"])
    return corpus.tokens(docs, "doc_id", "text", ["doctype"])


def token_frequency(spark, d):
    return corpus.frequencies(_words(spark, d))


def document_range(spark, d):
    return corpus.document_range(_words(spark, d), "doc_id")


def keyness_log_ratio(spark, d):
    rows = _words(spark, d)
    freq = corpus.frequencies(rows, ["doctype"])
    return _rounded(corpus.keyness(freq.where("doctype = 'comment'"), freq.where("doctype = 'article'")), "log_ratio")


def collocates_mi(spark, d):
    rows = _words(spark, d)
    return _rounded(corpus.mutual_information(corpus.neighbour_pairs(rows, "doc_id"), corpus.frequencies(rows), 5), "mi")


_WORDS = "w AS (SELECT doc_id, doctype, unnest(range(len(t))) AS pos, unnest(t) AS word FROM (SELECT doc_id, doctype, regexp_extract_all(lower(text), '[a-z0-9\\-]{3,50}') AS t FROM documents WHERE text IS NOT NULL))"


def lifecycle_tally(spark, d):
    """Deliveries and articles by the stage that touched them last, with what is still to do."""
    rows = _one(spark, d, "lastModifier", "quotes", "quotesUpdated")
    return rows.groupBy("lastModifier").agg(F.count("*").alias("articles"), F.sum(F.col("quotes").isNull().cast("long")).alias("without_quotes"), F.sum(F.col("quotesUpdated").isNull().cast("long")).alias("without_annotation"))


def long_bodies(spark, d):
    rows = _one(spark, d, "body").where("body is not null")
    return rows.groupBy((F.length("body") > 20000).alias("too_long")).agg(F.count("*").alias("articles"), F.max(F.length("body")).cast("long").alias("longest"))


def upsert_media_daily(spark, d):
    """State after a corrected roll-up of the first outlet days is written over the table, twice."""
    old = _daily(spark, d).where("outlet is not null").select("outlet", F.to_date("publishedAt").alias("day"), "totalArticles").dropDuplicates(["outlet", "day"])
    new = old.where("dayofmonth(day) <= 3").withColumn("totalArticles", F.coalesce("totalArticles", F.lit(0)) + 1)
    once = upsert.upsert(old, new, ["outlet", "day"])
    return upsert.upsert(once, new, ["outlet", "day"])


def insert_if_absent(spark, d):
    old = table(spark, d, "outlets").where("lang = 'en'").select("outlet", "domain")
    return upsert.insert_if_absent(old, table(spark, d, "outlets").select("outlet", "domain"), ["outlet"])


def merge_side_collection(spark, d):
    """Fields of a side table, where present, replace those of the outlets."""
    old = table(spark, d, "outlets").select("outlet", "lang", "tz")
    side = old.select("outlet", F.when(F.col("lang") == "fr", "fr-CA").alias("lang"))
    return upsert.merge_fields(old, side, "outlet")


def cache_write_back(spark, d):
    return gender.cache_updates(table(spark, d, "gender_cache").where("name is not null and gender is not null").select("name", "gender"))


def stage_gate(spark, d):
    """Articles that wait for quotes, and those that wait for annotation."""
    rows = _one(spark, d, "lastModifier", "quotes", "quotesUpdated")
    waits = F.when(pr.stage("mediaCollectors", "quotes"), "quotes").when(pr.stage("quote_extractor", "quotesUpdated") | pr.stage("quote_extractor_fr", "quotesUpdated"), "annotation")
    return rows.withColumn("waits", waits).where("waits is not null").select("_id", "waits")


def speaker_overlap_counts(spark, d):
    """Speakers of updated against original quotes, counted many to many."""
    a = _ok(spark, d, "quotes", "quotesUpdated")
    span = lambda f: entities.quote_rows(a, f).where("s is not null").select("doc", F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    return evaluation.overlap_counts(span("quotesUpdated"), span("quotes"))


def url_new(spark, d):
    """Later articles whose address stands under no spelling among the earlier ones."""
    rows = table(spark, d, "articles").where("url is not null").select("url", (F.dayofmonth("lastModified") <= 15).alias("early"))
    return ingest.new_articles(rows.where("not early").select("url"), rows.where("early").select("url")).select(ux.identity(F.col("url")).alias("identity"))


def crawl_outcomes(spark, d):
    rows = table(spark, d, "articles").where("url is not null").select("url", "body", (F.dayofmonth("lastModified") <= 15).alias("early"))
    early = rows.where("early").select("url")
    return ingest.tally(ingest.classify(rows, early, early.limit(0)))


def month_labels(spark, d):
    day = F.to_date("publishedAt")
    return _daily(spark, d).select(dates.month_id(day).alias("id"), dates.month_label(day).alias("label"), dates.month_label(day, True).alias("short"), dates.week_number(day).alias("week"), day.alias("day")).distinct()


def crawl_dates(spark, d):
    rows = table(spark, d, "articles").select("publishedAt").distinct()
    return rows.select("publishedAt", F.date_format(dates.crawl_date(F.col("publishedAt")), "yyyy-MM-dd HH:mm:ss").alias("read")).where("read is not null")


def outlet_records(spark, d):
    """Weekly rows of each outlet as one list, as a service returns them."""
    w = weekly_info(spark, d)
    row = F.to_json(F.struct("weekBegin", "weekEnd", "totalFemales", "totalMales", "totalUnknowns"))
    return w.groupBy("outlet").agg(F.array_join(F.array_sort(F.collect_list(row)), ";").alias("rows"), F.count("*").alias("weeks"))


def text_analysis(spark, d):
    """People and sources of each text by gender, from the text alone."""
    cache = table(spark, d, "gender_cache").where("name is not null")
    rows = _one(spark, d, "body")
    return analyzer.analyze(rows, [gender.name_cache(cache)], [gender.first_name_cache(cache)])[1]


SPARK = {
    "stage_gate": stage_gate, "speaker_overlap_counts": speaker_overlap_counts, "url_new": url_new, "crawl_outcomes": crawl_outcomes, "month_labels": month_labels, "crawl_dates": crawl_dates, "outlet_records": outlet_records, "text_analysis": text_analysis,
    "db_stats": db_stats, "outlet_stats": outlet_stats,
    "top_sources_female": _top(["sourcesFemale"]), "top_sources_male": _top(["sourcesMale"]), "top_sources_unknown": _top(["sourcesUnknown"]), "top_sources_all": _top(["sourcesFemale", "sourcesMale"]), "bottom_sources_female": _top(["sourcesFemale"], 100, True),
    **{f"{c}_author_sources": _cohort(c) for c in COHORTS},
    "gender_cascade": gender_cascade, "people_by_gender": people_by_gender, "author_dedup": author_dedup, "author_clean": author_clean,
    "url_canonical": url_canonical, "url_first_seen": url_first_seen, "article_type": article_type, "url_admission": url_admission, "url_variants": url_variants,
    "clean_text_en": clean_text_en, "clean_text_fr": clean_text_fr, "clean_name": clean_names, "name_near_cache": name_near_cache,
    "info_by_date_outlet": info_by_date_outlet, "info_by_date_total": info_by_date_total, "weekly_info": weekly_info, "weekly_article_counts_filled": weekly_article_counts_filled,
    "daily_female_share": daily_female_share, "daily_female_share_filled": daily_female_share_filled, "daily_female_share_rolling7": daily_female_share_rolling7, "daily_female_share_trend": daily_female_share_trend,
    "alias_merged_top_sources": alias_merged_top_sources, "quote_type_shares": quote_type_shares, "quote_spans": quote_spans, "speaker_alignment": speaker_alignment, "floating_reference": floating_reference,
    "list_eval_metrics": list_eval_metrics, "gender_ratio": gender_ratio, "quote_eval_metrics": quote_eval_metrics, "heuristic_quotes": heuristic_quotes, "english_quotes": english_quotes, "guillemet_quotes": guillemet_quotes, "selon_quotes": selon_quotes, "quote_stats_summary": quote_stats_summary,
    "token_frequency": token_frequency, "document_range": document_range, "keyness_log_ratio": keyness_log_ratio, "collocates_mi": collocates_mi,
    "lifecycle_tally": lifecycle_tally, "long_bodies": long_bodies, "upsert_media_daily": upsert_media_daily, "insert_if_absent": insert_if_absent, "merge_side_collection": merge_side_collection, "cache_write_back": cache_write_back,
}

_AUTH = f"WITH {LATEST}, a AS (SELECT _id, list_distinct(list_filter(authors, lambda x: x <> '')) AS l FROM art WHERE authors IS NOT NULL)"
_BL = "[" + ", ".join(f"'{w.lower()}'" for w in BLOCKLIST) + "]"

_BARE = "publishedAt"
for _m in dates.ZONE_MARKS:
    _BARE = f"replace({_BARE}, '{_m}', '')"
_BARE = f"regexp_replace(trim({_BARE}), '^[A-Za-z]{{3}}, ', '')"

SQL = {
    "stage_gate": f"WITH {LATEST} SELECT * FROM (SELECT _id, CASE WHEN lastModifier = 'mediaCollectors' AND quotes IS NULL THEN 'quotes' WHEN lastModifier IN ('quote_extractor', 'quote_extractor_fr') AND quotesUpdated IS NULL THEN 'annotation' END AS waits FROM art) WHERE waits IS NOT NULL",
    "speaker_overlap_counts": BASE + ", x AS (SELECT _id, unnest(quotesUpdated) AS q FROM ok), y AS (SELECT _id, unnest(quotes) AS q FROM ok), sx AS (SELECT _id, regexp_extract(q.speaker_index, '(\\d+), ?(\\d+)', 1)::INT AS a, regexp_extract(q.speaker_index, '(\\d+), ?(\\d+)', 2)::INT AS b FROM x WHERE q.speaker_index SIMILAR TO '\\(\\d+, ?\\d+\\)'), sy AS (SELECT _id, regexp_extract(q.speaker_index, '(\\d+), ?(\\d+)', 1)::INT AS c, regexp_extract(q.speaker_index, '(\\d+), ?(\\d+)', 2)::INT AS d FROM y WHERE q.speaker_index SIMILAR TO '\\(\\d+, ?\\d+\\)'), t AS (SELECT count(*) AS tp FROM sx JOIN sy USING (_id) WHERE least(b, d) - greatest(a, c) >= 2) SELECT tp, (SELECT count(*) FROM sx) - tp AS fn, (SELECT count(*) FROM sy) - tp AS fp FROM t",
    "url_new": f"WITH u AS (SELECT DISTINCT {_IDENT} AS identity, dayofmonth(lastModified AT TIME ZONE 'UTC') <= 15 AS early FROM articles WHERE url IS NOT NULL) SELECT identity FROM u WHERE NOT early AND identity NOT IN (SELECT identity FROM u WHERE early)",
    "crawl_outcomes": f"WITH u AS (SELECT {_IDENT} AS identity, body, dayofmonth(lastModified AT TIME ZONE 'UTC') <= 15 AS early FROM articles WHERE url IS NOT NULL) SELECT CASE WHEN identity IN (SELECT identity FROM u WHERE early) THEN 'URL Present' WHEN body IS NULL OR trim(body) = '' THEN 'Invalid Body' ELSE 'Inserted' END AS status, count(*) AS n FROM u GROUP BY 1",
    "month_labels": "SELECT DISTINCT strftime((publishedAt AT TIME ZONE 'UTC')::DATE, '%Y%m') AS id, strftime((publishedAt AT TIME ZONE 'UTC')::DATE, '%B %Y') AS label, strftime((publishedAt AT TIME ZONE 'UTC')::DATE, '%b-%Y') AS short, strftime((publishedAt AT TIME ZONE 'UTC')::DATE, '%U')::INT AS week, (publishedAt AT TIME ZONE 'UTC')::DATE AS day FROM media_daily",
    "crawl_dates": f"SELECT publishedAt, strftime(coalesce(try_strptime({_BARE}, '%d %b %Y %H:%M:%S'), try_strptime({_BARE}, '%Y-%m-%d %H:%M:%S')), '%Y-%m-%d %H:%M:%S') AS read FROM (SELECT DISTINCT publishedAt FROM articles) WHERE coalesce(try_strptime({_BARE}, '%d %b %Y %H:%M:%S'), try_strptime({_BARE}, '%Y-%m-%d %H:%M:%S')) IS NOT NULL",
    "db_stats": f"{BASE} SELECT * FROM (SELECT count(*) AS totalArticles, coalesce(sum(quoteCount),0)::BIGINT AS totalQuotes, {_sum_sql(('people', 'sources'))} FROM ok) WHERE totalArticles > 0",
    "outlet_stats": f"{BASE} SELECT outlet, count(*) AS totalArticles, coalesce(sum(quoteCount),0)::BIGINT AS totalQuotes, {_sum_sql(('people', 'sources'))} FROM ok GROUP BY 1",
    "top_sources_female": _top_sql(["sourcesFemale"]), "top_sources_male": _top_sql(["sourcesMale"]), "top_sources_unknown": _top_sql(["sourcesUnknown"]), "top_sources_all": _top_sql(["sourcesFemale", "sourcesMale"]), "bottom_sources_female": _top_sql(["sourcesFemale"], 100, "ASC"),
    **{f"{c}_author_sources": _cohort_sql(c) for c in COHORTS},
    "gender_cascade": f"WITH {LATEST}, names AS (SELECT DISTINCT unnest(people) AS name FROM art), {CACHE}, {CASCADE} SELECT name, gender FROM resolved",
    "people_by_gender": f"WITH {LATEST}, names AS (SELECT DISTINCT unnest(people) AS name FROM art), {CACHE}, {CASCADE} SELECT _id, gender, count(*) AS n, string_agg(name, ', ' ORDER BY name) AS names FROM (SELECT DISTINCT _id, unnest(people) AS name FROM art) JOIN resolved USING (name) GROUP BY 1, 2",
    "author_dedup": f"{_AUTH} SELECT _id, array_to_string(list_sort(list_filter(l, lambda x: len(list_filter(l, lambda y: lower(x) <> lower(y) AND contains(lower(x), lower(y)))) = 0)), '; ') AS kept FROM a",
    "author_clean": f"WITH {LATEST}, a AS (SELECT _id, list_distinct(list_filter(coalesce(authors, []), lambda x: len(regexp_split_to_array(trim(x), '\\s+')) > 1 AND NOT list_has_any(regexp_split_to_array(lower(x), '\\s+'), {_BL}))) AS l FROM art), b AS (SELECT _id, list_filter(l, lambda x: len(list_filter(l, lambda y: lower(x) <> lower(y) AND contains(lower(x), lower(y)) AND y <> '')) = 0) AS l FROM a) SELECT _id, array_to_string(list_sort(list_filter(list_transform(l, lambda x: {_CN.format(x='x')}), lambda x: x <> '')), '; ') AS authors FROM b",
    "url_canonical": f"SELECT url, {_CANON} AS canonical, {_IDENT} AS identity, {_HOST} AS host FROM (SELECT DISTINCT url FROM articles WHERE url IS NOT NULL)",
    "url_first_seen": f"SELECT {_IDENT} AS identity, strftime(min(lastModified) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS firstSeen, count(*) AS deliveries FROM articles WHERE url IS NOT NULL GROUP BY 1",
    "article_type": f"WITH {LATEST} SELECT _id, CASE WHEN url IS NULL OR trim(url) = '' OR {_HOST} = '' THEN 'unknown' WHEN list_has_any(string_split(lower({_PATH}), '/'), ['opinion','opinions']) THEN 'opinion' ELSE 'hard news' END AS type FROM art",
    "url_admission": f"WITH {LATEST}, b AS (SELECT _id, url, {_HOST} AS h, regexp_replace(lower(domain), '^www\\.', '') AS dom FROM art LEFT JOIN outlets USING (outlet)) SELECT _id, coalesce((h = dom OR ends_with(h, '.' || dom)) AND h <> 'blogs.' || dom AND NOT contains(url, '/actualites/'), false) AS admitted FROM b",
    "url_variants": f"WITH {LATEST} SELECT DISTINCT _id, unnest([url, 'https://' || {_IDENT}, 'https://www.' || {_IDENT}, 'http://' || {_IDENT}, 'http://www.' || {_IDENT}]) AS spelling FROM art WHERE url IS NOT NULL",
    "clean_text_en": f"WITH {LATEST} SELECT _id, translate(replace(replace(replace(replace(replace(translate(replace(title, chr(160), ' '), '{ACC}', '{PLAIN}'), chr(10), '.' || chr(10) || ' '), '..' || chr(10) || ' ', '.' || chr(10) || ' '), '. .' || chr(10) || ' ', '.' || chr(10) || ' '), '  ', ' '), '\\n', ' '), '”“〝〞', '\"\"\"\"') AS title, translate(title, '{ACC}', '{PLAIN}') AS folded FROM art WHERE title IS NOT NULL",
    "clean_name": f"WITH {LATEST}, n AS (SELECT DISTINCT unnest(people) AS name FROM art) SELECT name, {_CN.format(x='name')} AS clean, len({_TOK.format(x='name')}) <= 1 OR len({_TOK.format(x='name')}) > 6 AS invalid, CASE WHEN contains(trim(name), ' ') THEN {_TOK.format(x='name')}[1] END AS first, regexp_matches(name, '[0-9]') AS digit FROM n",
    "info_by_date_outlet": f"WITH s AS (SELECT outlet, {_SUMS} FROM media_daily GROUP BY 1) SELECT outlet, {_SHARES}, round(totalArticles::DOUBLE / sum(totalArticles) OVER (), 6) AS perArticles FROM s",
    "info_by_date_total": f"WITH s AS (SELECT 'all' AS outlet, {_SUMS} FROM media_daily) SELECT outlet, {_SHARES} FROM s",
    "weekly_info": f"WITH s AS (SELECT outlet, ((publishedAt AT TIME ZONE 'UTC')::DATE - dayofweek((publishedAt AT TIME ZONE 'UTC')::DATE)::INT)::DATE AS weekBegin, {_SUMS} FROM media_daily GROUP BY 1, 2) SELECT outlet, weekBegin, {_SHARES}, (weekBegin + 6)::DATE AS weekEnd FROM s",
    "weekly_article_counts_filled": "WITH s AS (SELECT outlet, ((publishedAt AT TIME ZONE 'UTC')::DATE + ((7 - dayofweek((publishedAt AT TIME ZONE 'UTC')::DATE)) % 7)::INT)::DATE AS week, coalesce(sum(totalArticles),0)::BIGINT AS n FROM media_daily WHERE outlet IS NOT NULL GROUP BY 1, 2), g AS (SELECT o.outlet, w.week FROM (SELECT DISTINCT outlet FROM s) o, (SELECT unnest(generate_series(min(week), max(week), INTERVAL 7 DAY))::DATE AS week FROM s) w) SELECT g.outlet, g.week, coalesce(n, 0)::BIGINT AS totalArticles FROM g LEFT JOIN s USING (outlet, week)",
    "daily_female_share": f"WITH {_SHARE.format(w='true')} SELECT outlet, day, round(share, 6) AS share FROM sh",
    "daily_female_share_filled": f"WITH {_FILLED} SELECT outlet, day, round(share, 6) AS share FROM fil",
    "daily_female_share_rolling7": f"WITH {_FILLED} SELECT outlet, day, round(share, 6) AS share, round(avg(share) OVER (PARTITION BY outlet ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling FROM fil",
    "daily_female_share_trend": f"WITH {_SHARE.format(w='true')} SELECT outlet, round(regr_slope(share, x), 6) AS slope, round(regr_intercept(share, x), 3) AS intercept, count(*) AS days FROM (SELECT outlet, share, (day - DATE '1970-01-01')::DOUBLE AS x FROM sh) GROUP BY 1",
    "alias_merged_top_sources": BASE + ", c AS (SELECT 'female' AS gender, unnest(sourcesFemale) AS name FROM ok UNION ALL SELECT 'male', unnest(sourcesMale) FROM ok), al(primary_name, alias) AS (VALUES " + ", ".join(f"('{p}', '{a}')" for p, a in ALIASES) + "), m AS (SELECT gender, coalesce(primary_name, name) AS name, count(*)::BIGINT AS count FROM c LEFT JOIN al ON name = alias GROUP BY 1, 2) SELECT gender, name, count, rank FROM (SELECT *, row_number() OVER (PARTITION BY gender ORDER BY count DESC, name)::INT AS rank FROM m) WHERE rank <= 15",
    "quote_type_shares": _QROWS + " SELECT quote_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 3) AS percent FROM sp GROUP BY 1",
    "quote_spans": _QROWS + " SELECT quote_type, count(*) AS n, sum(t2 - t1)::BIGINT AS quote_chars, sum(s2 - s1)::BIGINT AS speaker_chars, sum((s1 IS NULL)::INT)::BIGINT AS no_speaker FROM sp GROUP BY 1",
    "speaker_alignment": _QROWS + ", h AS (SELECT a.doc, a.quote, b.speaker, row_number() OVER (PARTITION BY a.doc, a.quote ORDER BY b.speaker, b.s1) AS rn FROM sp a JOIN sp b ON a.doc = b.doc AND b.speaker <> '' AND a.s1 IS NOT NULL AND b.s1 IS NOT NULL AND least(a.s2, b.s2) - greatest(a.s1, b.s1) >= 2) SELECT sp.doc, sp.quote::INT AS quote, h.speaker AS entity FROM sp LEFT JOIN (SELECT * FROM h WHERE rn = 1) h ON sp.doc = h.doc AND sp.quote = h.quote",
    "floating_reference": _QROWS + ", z AS (SELECT doc, quote, t1, CASE WHEN quote % 3 = 2 THEN '' ELSE speaker END AS speaker FROM sp) SELECT doc, quote::INT AS quote, CASE WHEN coalesce(speaker <> '', false) THEN speaker ELSE last_value(nullif(speaker, '') IGNORE NULLS) OVER (PARTITION BY doc ORDER BY t1 NULLS FIRST, quote ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS reference FROM z",
    "list_eval_metrics": BASE + ", s AS (SELECT outlet, sum(len(list_intersect(people, sources)))::BIGINT AS tp, sum(len(list_filter(list_distinct(sources), lambda x: NOT list_contains(people, x))))::BIGINT AS fp, sum(len(list_filter(list_distinct(people), lambda x: NOT list_contains(sources, x))))::BIGINT AS fn FROM ok GROUP BY 1), r AS (SELECT *, 100.0*tp/nullif(tp+fp,0) AS p, 100.0*tp/nullif(tp+fn,0) AS q FROM s) SELECT outlet, tp, fp, fn, round(p,3) AS precision, round(q,3) AS recall, round(2*p*q/nullif(p+q,0),3) AS f1 FROM r",
    "gender_ratio": BASE + " SELECT outlet, " + ", ".join(f"round(coalesce(sum(sources{c}Count)::DOUBLE / nullif(sum(sourcesFemaleCount+sourcesMaleCount+sourcesUnknownCount), 0), 0), 3) AS {c.lower()}" for c in ("Female", "Male", "Unknown")) + " FROM ok GROUP BY 1",
    "quote_stats_summary": BASE + ", r AS (SELECT len(quotesUpdated) AS quotes, len(list_filter(quotesUpdated, lambda q: q.speaker = '')) AS speakerless, len(list_filter(quotesUpdated, lambda q: q.verb = '')) AS verbless, len(list_filter(quotesUpdated, lambda q: q.is_floating_quote)) AS floating, coalesce(speakersNotCountedInSources, 0) AS not_counted FROM ok), l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS counter, {c}::DOUBLE AS value FROM r" for c in ("quotes", "speakerless", "verbless", "floating", "not_counted")) + ") SELECT counter, round(sum(value), 6) AS total, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median, round(stddev_samp(value), 6) AS std, round(sum(value) / (SELECT sum(quotes) FROM r), 6) AS share FROM l GROUP BY 1",
    "token_frequency": f"WITH {_WORDS} SELECT word, count(*) AS n FROM w GROUP BY 1",
    "document_range": f"WITH {_WORDS} SELECT word, count(DISTINCT doc_id) AS docs FROM w GROUP BY 1",
    "keyness_log_ratio": f"WITH {_WORDS}, a AS (SELECT word, count(*) AS n FROM w WHERE doctype = 'comment' GROUP BY 1), b AS (SELECT word, count(*) AS n FROM w WHERE doctype = 'article' GROUP BY 1), j AS (SELECT coalesce(a.word, b.word) AS word, coalesce(a.n, 0) AS n1, coalesce(b.n, 0) AS n2 FROM a FULL JOIN b ON a.word = b.word) SELECT word, n1, n2, round(log2(((n1+0.5)/((SELECT sum(n1) FROM j)::DOUBLE+0.5)) / ((n2+0.5)/((SELECT sum(n2) FROM j)::DOUBLE+0.5))), 6) AS log_ratio FROM j",
    "collocates_mi": f"WITH {_WORDS}, n AS (SELECT word AS a, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS b FROM w), p AS (SELECT a, b, count(*) AS n FROM n WHERE b IS NOT NULL GROUP BY 1, 2), f AS (SELECT word, count(*) AS n FROM w GROUP BY 1) SELECT p.a, p.b, p.n, round(log2((p.n::DOUBLE/(SELECT sum(n) FROM p)) / ((x.n::DOUBLE/(SELECT sum(n) FROM f)) * (y.n::DOUBLE/(SELECT sum(n) FROM f)))), 6) AS mi FROM p JOIN f x ON x.word = p.a JOIN f y ON y.word = p.b WHERE p.n >= 5",
    "lifecycle_tally": f"WITH {LATEST} SELECT lastModifier, count(*) AS articles, sum((quotes IS NULL)::INT)::BIGINT AS without_quotes, sum((quotesUpdated IS NULL)::INT)::BIGINT AS without_annotation FROM art GROUP BY 1",
    "long_bodies": f"WITH {LATEST} SELECT length(body) > 20000 AS too_long, count(*) AS articles, max(length(body))::BIGINT AS longest FROM art WHERE body IS NOT NULL GROUP BY 1",
    "upsert_media_daily": "SELECT outlet, day, CASE WHEN dayofmonth(day) <= 3 THEN coalesce(n, 0) + 1 ELSE n END AS totalArticles FROM (SELECT outlet, (publishedAt AT TIME ZONE 'UTC')::DATE AS day, any_value(totalArticles) AS n FROM media_daily WHERE outlet IS NOT NULL GROUP BY 1, 2)",
    "insert_if_absent": "SELECT outlet, domain FROM outlets",
    "merge_side_collection": "SELECT outlet, CASE WHEN lang = 'fr' THEN 'fr-CA' ELSE lang END AS lang, tz FROM outlets",
    "cache_write_back": f"SELECT DISTINCT unnest([lower(name), lower(translate(name, '{ACC}', '{PLAIN}'))]) AS name, gender FROM gender_cache WHERE name IS NOT NULL AND gender IS NOT NULL",
    "name_near_cache": f"WITH n AS (SELECT DISTINCT regexp_replace(lower(translate(name, '{ACC}', '{PLAIN}')), '[^ -~]', '', 'g') AS a FROM gender_cache WHERE name IS NOT NULL) SELECT x.a, y.a AS b FROM n x JOIN n y ON x.a < y.a WHERE levenshtein(x.a, y.a) <= 1 AND x.a <> '' AND y.a <> ''",
}

"""Mixed timestamp texts to one instant in UTC (problem 6).

Every text is matched against the formats below; each match that names a possible date is a
*candidate* (some texts, such as 03/04/2021, have two). An expectation-maximisation over the
mixture of formats of each source turns candidates into posteriors: a text adds to the
weights of its source's formats in proportion to its likelihood under each valid reading, so
the source's own texts with one reading only (25/04/2021) decide how its others are read. The
day order that a source states is a prior of ``STRENGTH`` texts, split by how often such
statements hold (``TRUST``, and the sources whose texts show their order): it decides where a source shows nothing, and
gives way to five texts that contradict it. A reading is taken if its posterior reaches ``SURE``; otherwise the text stays marked
ambiguous. Texts without zone are read in the source's home zone; a clock reading which that
zone shows twice or never is marked and has no instant.

Everything runs on built-in expressions; only the EM, over one row for each source and set of
formats, runs in Python.

Statuses: exact, ambiguous, no_zone, clock_twice, clock_never, impossible, unreadable,
date_only, missing. Null text -> missing; blank text -> unreadable; unknown source and a text
without zone -> no_zone; a repeated key counts once (the smallest text stands for it); an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from newsweft.session import cut_lineage

#: Posterior from which a reading is taken.
SURE = 0.99
#: Texts (a fraction of one) that a source's stated day order counts as, and as how many right and wrong statements trust in them begins.
STRENGTH, TRUST = 0.05, (199.0, 1.0)
#: Years in which a publication time is plausible; others have the likelihood ``FAR_LIKELIHOOD``.
YEARS = (1990, 2100)
FAR_LIKELIHOOD = 1e-6
ROUNDS = 30

#: Offsets from UTC, in minutes, of the zone abbreviations of Canada in English and French.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "TUC": 0,
    "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "YST": -540,
    "HNT": -210, "HAT": -150, "HNA": -240, "HAA": -180, "HNE": -300, "HAE": -240, "HNC": -360, "HAC": -300,
    "HNR": -420, "HAR": -360, "HNP": -480, "HAP": -420,
}
#: Names of months in English and French.
MONTHS = {
    1: ["jan", "january", "janv", "janvier"], 2: ["feb", "february", "fév", "févr", "février", "fevrier"],
    3: ["mar", "march", "mars"], 4: ["apr", "april", "avr", "avril"], 5: ["may", "mai"],
    6: ["jun", "june", "juin"], 7: ["jul", "july", "juil", "juillet"], 8: ["aug", "august", "août", "aout"],
    9: ["sep", "sept", "september", "septembre"], 10: ["oct", "october", "octobre"],
    11: ["nov", "november", "novembre"], 12: ["dec", "december", "déc", "décembre", "decembre"],
}

_ZONE = r"(?:\s*(z|[a-z]{2,4}|(?:utc|gmt)?[+−-]\d{1,2}:?(?:\d{2})?))?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_HALF = r"(?:\s*([ap])\.?\s?m\.?)?"
_AT = r"(?:\s*,\s*|\s+at\s+|\s+à\s+|\s*t\s*|\s+)"
_WEEKDAY = r"(?:[a-z]{3,9}\.?,?\s+)?"

#: name -> (pattern, places of year, month, day, hour, minute, second, fraction, am/pm, zone; 0 where there is none)
FORMATS: dict[str, tuple[str, tuple[int, ...]]] = {
    "iso": (rf"^(\d{{4}})[-/](\d{{1,2}})[-/](\d{{1,2}}){_AT}{_CLOCK}{_HALF}{_ZONE}(?:\[[a-z_/+-]+\])?$", (1, 2, 3, 4, 5, 6, 7, 8, 9)),
    "basic": (rf"^(\d{{4}})(\d{{2}})(\d{{2}})t(\d{{2}})(\d{{2}})(\d{{2}})?(?:\.(\d{{1,9}}))?{_ZONE}$", (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    "slash_dmy": (rf"^{_WEEKDAY}(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}){_AT}{_CLOCK}{_HALF}{_ZONE}$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    "slash_mdy": (rf"^{_WEEKDAY}(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}){_AT}{_CLOCK}{_HALF}{_ZONE}$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
    "dot_dmy": (rf"^{_WEEKDAY}(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}){_AT}{_CLOCK}{_HALF}{_ZONE}$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    "day_name": (rf"^{_WEEKDAY}(\d{{1,2}})(?:er|st|nd|rd|th)?[\s-]+([a-zéû]{{3,10}})\.?,?[\s-]+(\d{{4}}){_AT}{_CLOCK}{_HALF}{_ZONE}$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    "name_day": (rf"^{_WEEKDAY}([a-zéû]{{3,10}})\.?\s+(\d{{1,2}})(?:er|st|nd|rd|th)?,?\s+(\d{{4}}){_AT}{_CLOCK}{_HALF}{_ZONE}$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
    "day_name_h": (rf"^{_WEEKDAY}(\d{{1,2}})(?:er)?\s+([a-zéû]{{3,10}})\.?,?\s+(\d{{4}}){_AT}(\d{{1,2}})\s?h\s?(\d{{2}})(?:\s?min)?(?:\s?(\d{{2}})\s?s)?{_ZONE}$", (3, 2, 1, 4, 5, 6, 0, 0, 7)),
}
_DATE_ONLY = rf"^{_WEEKDAY}(?:\d{{4}}[-/]\d{{1,2}}[-/]\d{{1,2}}|\d{{1,2}}[/.]\d{{1,2}}[/.]\d{{4}}|\d{{1,2}}(?:er|st|nd|rd|th)?\s+[a-zéû]{{3,10}}\.?,?\s+\d{{4}}|[a-zéû]{{3,10}}\.?\s+\d{{1,2}},?\s+\d{{4}})$"


def _lookup(key: Column, table: dict) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def _groups(text: Column, name: str) -> Column:
    """struct(fmt, parts): the pieces of ``text`` in one format, in the order year … zone; null if it isn't in it."""
    pattern, places = FORMATS[name]
    template = "\u0001".join(f"${k}" if k else "" for k in places[:9])
    return F.when(text.rlike(pattern), F.struct(F.lit(name).alias("fmt"), F.split(F.regexp_replace(text, pattern, template), "\u0001").alias("parts")))


def _reading(group: Column) -> Column:
    """struct(fmt, us, zoned, zone_ok) of one struct(fmt, parts); ``us`` is null if it names no possible time."""
    part = lambda k: F.nullif(group["parts"][k], F.lit(""))
    months = {word: n for n, words in MONTHS.items() for word in words} | {str(n).zfill(w): n for n in range(1, 13) for w in (1, 2)}
    half, zone, hour = part(7), F.upper(part(8)), part(3).cast("int")
    hour = F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    second = F.coalesce(part(5), F.lit("0")).cast("int")
    micros = F.substring(F.rpad(F.coalesce(part(6), F.lit("0")), 9, "0"), 1, 6).cast("long")
    stamp = F.try_make_timestamp(part(0).cast("int"), _lookup(part(1), months), part(2).cast("int"), hour, part(4).cast("int"), F.when(second < 60, second).cast("double"), F.lit("UTC"))
    digits = F.translate(F.regexp_replace(zone, "^(UTC|GMT)(?=.)", ""), "−", "-")
    spec = r"^[+-](\d{1,2}):?(\d{2})?$"
    minutes = (F.regexp_extract(digits, spec, 1).try_cast("int") * 60 + F.coalesce(F.regexp_extract(digits, spec, 2).try_cast("int"), F.lit(0))) * F.when(digits.startswith("-"), -1).otherwise(1)
    offset = F.when(digits.rlike(spec), minutes).otherwise(_lookup(zone, ZONE_MINUTES))
    return F.struct(
        group["fmt"].alias("fmt"),
        (F.unix_micros(stamp) + micros - F.coalesce(offset, F.lit(0)).cast("long") * F.lit(60_000_000)).alias("us"),
        zone.isNotNull().alias("zoned"),
        (zone.isNull() | offset.isNotNull()).alias("zone_ok"),
    )


#: name -> (pattern, microseconds in one unit)
EPOCHS = {"epoch_s": (r"^-?\d{9,11}$", 1_000_000), "epoch_ms": (r"^-?\d{12,14}$", 1000), "epoch_us": (r"^-?\d{15,17}$", 1)}


def _epoch(text: Column, name: str) -> Column:
    pattern, scale = EPOCHS[name]
    return F.when(text.rlike(pattern), F.struct(F.lit(name).alias("fmt"), (text.try_cast("long") * scale).alias("us"), F.lit(True).alias("zoned"), F.lit(True).alias("zone_ok")))


def statement_trust(counts: DataFrame) -> float:
    """The share of stated day orders that hold, by the sources whose texts with one reading show their order; one row comes to the driver."""
    shows = lambda one, other: F.sum(F.when(F.array_contains("fmts", one) & ~F.array_contains("fmts", other), F.col("n")).otherwise(0))
    each = counts.where("day_first is not null").groupBy("source_key").agg(F.min("day_first").alias("stated"), shows("slash_dmy", "slash_mdy").alias("dmy"), shows("slash_mdy", "slash_dmy").alias("mdy"))
    right, shown = each.where("dmy <> mdy").agg(F.sum(((F.col("dmy") > F.col("mdy")) == F.col("stated")).cast("long")), F.count("*")).first()
    return ((right or 0) + TRUST[0]) / (shown + sum(TRUST))


def _mixture(rows: pd.DataFrame, rounds: int) -> pd.DataFrame:
    """EM for one source: the weights of its formats, from the counts of its sets of candidates."""
    names = sorted({f for fs in rows["fmts"] for f in fs})
    prior = dict.fromkeys(names, 0.5)
    first, trust = rows["day_first"].iloc[0], float(rows["trust"].iloc[0])
    if first is not None and not pd.isna(first):
        for name, yes in (("slash_dmy", bool(first)), ("slash_mdy", not first)):
            if name in prior:
                prior[name] = STRENGTH * (trust if yes else 1 - trust)
    weight = {n: prior[n] / sum(prior.values()) for n in names}
    data = [(list(fs), list(ls), n) for fs, ls, n in zip(rows["fmts"], rows["likes"], rows["n"])]
    for _ in range(rounds):
        seen = dict(prior)
        for fs, ls, n in data:
            share = [weight[f] * x for f, x in zip(fs, ls)]
            total = sum(share) or 1.0
            for f, x in zip(fs, share):
                seen[f] += n * x / total
        total = sum(seen.values())
        new = {n: x / total for n, x in seen.items()}
        done = max(abs(new[n] - weight[n]) for n in names) < 1e-9
        weight = new
        if done:
            break
    return pd.DataFrame({"source_key": rows["source_key"].iloc[0], "weights": [list(weight.items())]})


def normalise_timestamps(rows: DataFrame, sources: DataFrame, key: str = "_id", text: str = "publishedAt", source: str = "outlet", rounds: int = ROUNDS) -> DataFrame:
    """(key, published_us bigint, fmt, posterior, status) for every key.

    ``sources``: one row per source with ``tz`` and ``day_first``; a source named twice counts once.
    """
    one = rows.groupBy(F.col(key).alias("k")).agg(F.min(F.struct(F.col(text).alias("t"), F.col(source).alias("s"))).alias("r"))
    home = sources.groupBy(F.col(source).alias("home")).agg(F.min("tz").alias("tz"), F.min("day_first").alias("day_first"))
    raw = F.trim(F.regexp_replace(F.col("t"), r"[\s\u00a0\u2009\u202f\u3000]+", " "))
    inner = F.regexp_extract(raw, r'^\{"\$date": ?"?([^"}]*)"?\}$', 1)
    text_in = F.when(inner != "", inner).otherwise(raw)
    base = (
        one.select("k", "r.t", "r.s")
        .join(home, F.col("s") == F.col("home"), "left")
        .select("k", "t", F.coalesce("s", F.lit("\u0000")).alias("source_key"), "tz", "day_first", F.lower(text_in).alias("x"), F.nullif(F.regexp_extract(text_in, r"\[([A-Za-z_/+-]+)\]$", 1), F.lit("")).alias("place"))
    )
    groups = F.array_compact(F.array(*[_groups(F.col("x"), n) for n in FORMATS]))
    dates = F.filter(F.transform(groups, _reading), lambda c: c["us"].isNotNull())
    stamps = F.array_compact(F.array(*[_epoch(F.col("x"), n) for n in EPOCHS]))
    base = cut_lineage(base.withColumn("c", F.concat(dates, stamps)))
    low, high = (int(pd.Timestamp(f"{y}-01-01").value // 1000) for y in YEARS)
    read = base.withColumn("fmts", F.transform("c", lambda c: c["fmt"])).withColumn("likes", F.transform("c", lambda c: F.when(c["us"].between(low, high), 1.0).otherwise(FAR_LIKELIHOOD)))
    counts = read.where(F.size("c") > 0).groupBy("source_key", "day_first", "fmts", "likes").agg(F.count("*").alias("n"))
    counts = cut_lineage(counts)
    counts = counts.withColumn("trust", F.lit(statement_trust(counts)))
    weights = counts.groupBy("source_key").applyInPandas(lambda part: _mixture(part, rounds), "source_key string, weights array<struct<name string, weight double>>")
    scored = read.join(weights, "source_key", "left").withColumn("w", F.map_from_entries(F.coalesce("weights", F.expr("cast(array() as array<struct<name string, weight double>>)"))))
    joint = F.zip_with("c", "likes", lambda c, x: F.struct((F.coalesce(F.try_element_at(F.col("w"), c["fmt"]), F.lit(0.0)) * x).alias("p"), c.alias("c")))
    scored = scored.withColumn("j", joint).withColumn("total", F.aggregate("j", F.lit(0.0), lambda a, x: a + x["p"])).withColumn("best", F.array_max("j"))
    agree = F.aggregate("j", F.lit(0.0), lambda a, x: a + F.when(x["c"]["us"] == F.col("best.c.us"), x["p"]).otherwise(0.0))
    scored = scored.withColumn("posterior", F.try_divide(agree, F.col("total")))

    best = F.col("best.c")
    zone = F.coalesce("place", "tz")
    local = F.timestamp_micros(best["us"])
    utc = F.when(zone.isNotNull(), F.to_utc_timestamp(local, zone))
    again = F.lit(False)
    for minutes in (30, 60, 120):
        for sign in (1, -1):
            again = again | (F.from_utc_timestamp(F.timestamp_micros(F.unix_micros(utc) + sign * minutes * 60_000_000), zone) == local)
    status = (
        F.when(F.col("t").isNull(), "missing")
        .when(F.size("c") == 0, F.when(F.col("x").rlike(_DATE_ONLY), "date_only").when(F.greatest(*[F.col("x").rlike(p) for p, _ in FORMATS.values()]), "impossible").otherwise("unreadable"))
        .when(F.col("posterior") < SURE, "ambiguous")
        .when(best["zoned"], F.when(best["zone_ok"], "exact").otherwise("unreadable"))
        .when(zone.isNull(), "no_zone")
        .when(F.from_utc_timestamp(utc, zone) != local, "clock_never")
        .when(again, "clock_twice")
        .otherwise("exact")
    )
    us = F.when(best["zoned"], best["us"]).otherwise(F.unix_micros(utc))
    return scored.withColumn("status", status).select(F.col("k").alias(key), F.when(F.col("status") == "exact", us).alias("published_us"), best["fmt"].alias("fmt"), "posterior", "status")


def found(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(_id, published_us) of the texts that mean exactly one instant."""
    return normalise_timestamps(rows, sources).where("published_us is not null").select("_id", "published_us")

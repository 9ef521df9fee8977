"""Quote extraction over a parser-neutral token column.

A token is a dict (struct) with i, text, lemma, pos, dep, head, start, end, sent and ent. A parser
fills the column; ``default_tokens`` is one without dependency labels. Rules are plain functions
over one document's tokens, run per partition in Arrow batches; every document is independent.

Quotes: speaker, quote, verb with spans, token count, type (letters Q, C, V, S in the order of
their parts) and whether the quote floats. Texts longer than 20,000 characters give no quotes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsweft.operators.predicates import MAX_BODY

MIN_WORDS, MIN_TOKENS, MAX_TOKENS = 4, 6, 100
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
KINDS = pa.struct([("speaker", pa.string()), ("speaker_span", SPAN), ("quote", pa.string()), ("quote_span", SPAN), ("verb", pa.string()), ("verb_span", SPAN), ("quote_token_count", pa.int32()), ("quote_type", pa.string()), ("is_floating_quote", pa.bool_())])
DDL = "struct<speaker string, speaker_span struct<start int, end int>, quote string, quote_span struct<start int, end int>, verb string, verb_span struct<start int, end int>, quote_token_count int, quote_type string, is_floating_quote boolean>"
#: A seed list of verbs that introduce quotes; callers pass their own.
VERBS_EN = set("say says said add adds added ask asks asked argue argues argued explain explains explained insist insists insisted note notes noted recall recalls recalled reply replied state states stated tell told warn warns warned write writes wrote".split())
VERBS_FR = set("dit disait affirme affirmait ajoute ajoutait explique expliquait précise soutient déplore raconte répond demande estime indique souligne déclare".split())
NOT_QUOTE_VERBS = {"is", "was", "be"}

_TOKEN = re.compile(r"\w+(?:[’'-]\w+)*|[^\w\s]")
_SENT_END = re.compile(r"[.!?]")


def default_tokens(text: str, verbs: set[str] = VERBS_EN | VERBS_FR) -> list[dict]:
    """Tokens with sentence numbers, a guess at verbs, and capitalised runs as PERSON."""
    out: list[dict] = []
    sent = 0
    for i, m in enumerate(_TOKEN.finditer(text)):
        w = m[0]
        out.append({"i": i, "text": w, "lemma": w.lower(), "pos": "VERB" if w.lower() in verbs else "X", "dep": "", "head": i, "start": m.start(), "end": m.end(), "sent": sent, "ent": ""})
        if _SENT_END.match(w):
            sent += 1
    run: list[int] = []
    for t in [*out, None]:
        if t and t["text"][:1].isupper() and t["text"].isalpha() or t and run and "-" in t["text"] and t["text"][:1].isupper():
            run.append(t["i"])
            continue
        if len(run) > 1:
            for i in run:
                out[i]["ent"] = "PERSON"
        run = []
    return out


def make(text: str, quote: tuple[int, int], speaker: tuple[int, int] | None, verb: tuple[int, int] | None, count: int, kind: str, floating: bool = False) -> dict:
    cut = lambda s: text[s[0] : s[1]] if s else ""
    span = lambda s: {"start": s[0], "end": s[1]} if s else None
    return {"speaker": cut(speaker), "speaker_span": span(speaker), "quote": cut(quote), "quote_span": span(quote), "verb": cut(verb), "verb_span": span(verb), "quote_token_count": count, "quote_type": kind, "is_floating_quote": floating}


def quote_type(text: str, quote: tuple[int, int], clause: tuple[int, int], verb: tuple[int, int] | None, speaker: tuple[int, int] | None) -> str:
    """Letters by position: both quotation marks around the clause (Q), the clause (C), the verb (V), the speaker (S)."""
    marks = [m.start() for m in re.finditer('"', text[quote[0] : quote[1]])]
    parts = [((clause[0] + clause[1]) / 2, "C")] + [(quote[0] + x, "Q") for x in ([marks[0], marks[-1]] if len(marks) > 1 else [])]
    for span, letter in ((verb, "V"), (speaker, "S")):
        if span:
            parts.append(((span[0] + span[1]) / 2, letter))
    return "".join(letter for _, letter in sorted(parts))


def subtree(tokens: list[dict], root: int) -> list[dict]:
    children: dict[int, list[int]] = {}
    for t in tokens:
        if t["head"] != t["i"]:
            children.setdefault(t["head"], []).append(t["i"])
    at, out = [root], []
    while at:
        i = at.pop()
        out.append(i)
        at += children.get(i, [])
    return [tokens[i] for i in sorted(out)]


def _span(tokens: list[dict]) -> tuple[int, int]:
    return tokens[0]["start"], tokens[-1]["end"]


def syntactic_quotes(text: str, tokens: list[dict], verbs: set[str] = VERBS_EN) -> list[dict]:
    """Clauses that complete a verb of speech, with the verb's subject as the speaker."""
    out = []
    for t in tokens:
        if t["dep"] != "ccomp":
            continue
        verb = tokens[t["head"]]
        if verb["text"].lower() not in verbs:
            continue
        subject = next((s for h in dict.fromkeys((verb["i"], verb["head"])) for s in tokens if s["head"] == h and s["dep"] == "nsubj" and s["i"] != h), None)
        if subject is None or subject["text"].lower() in ("i", "we"):
            continue
        clause = subtree(tokens, t["i"])
        speaker = _span(subtree(tokens, subject["i"]))
        span = _span(clause)
        kind = quote_type(text, span, span, (verb["start"], verb["end"]), speaker)
        if not text[span[0] : span[1]].strip() or (kind[0] == kind[-1] == "Q" and len(kind) > 3):
            continue
        out.append(make(text, span, speaker, (verb["start"], verb["end"]), len(clause), kind))
    return out


def according_to_quotes(text: str, tokens: list[dict]) -> list[dict]:
    """'According to' phrases: the phrase's object speaks, the rest of the sentence is the quote."""
    out = []
    for a, b in zip(tokens, tokens[1:]):
        if (a["text"].lower(), b["text"].lower()) != ("according", "to"):
            continue
        phrase = subtree(tokens, a["i"])
        if len(phrase) < 3:
            stop = next((t["i"] for t in tokens[b["i"] + 1 :] if t["text"] in ",.;" or t["sent"] != a["sent"]), len(tokens))
            phrase = tokens[a["i"] : stop]
        said = [t for t in phrase if t["i"] > b["i"] and t["text"] not in ",."]
        rest = [t for t in tokens if t["sent"] == a["sent"] and t["i"] not in {x["i"] for x in phrase}]
        before = [t for t in rest if t["i"] < a["i"]] if a["i"] > tokens[0]["i"] and any(t["i"] < a["i"] for t in rest) else rest
        words = [t for t in before if t["text"] not in ",.;"]
        if said and words:
            out.append(make(text, _span(words), _span(said), (a["start"], b["end"]), len(words), "AccordingTo"))
    return out


def floating_quotes(text: str, tokens: list[dict], known: list[dict], most: int = 5) -> list[dict]:
    """Quoted sentences that follow an attributed quote and inherit its speaker."""
    sents: dict[int, list[dict]] = {}
    for t in tokens:
        sents.setdefault(t["sent"], []).append(t)
    order = list(sents.values())
    out, k = [], 1
    while k < len(order):
        before, first = order[k - 1], order[k]
        a = _span(before)
        lead = next((q for q in known if q["quote_type"] in ("QCQSV", "QCQVS", "CSV") and 2 * (min(a[1], q["quote_span"]["end"]) - max(a[0], q["quote_span"]["start"])) >= min(a[1] - a[0], q["quote_span"]["end"] - q["quote_span"]["start"])), None)
        if lead is None or '"' not in [t["text"] for t in first[:3]]:
            k += 1
            continue
        run = None
        if sum(t["text"] == '"' for t in first) > 1:
            run = [first] if '"' in [t["text"] for t in first[-3:]] else None
        else:
            for n in range(1, most):
                if k + n >= len(order):
                    break
                marks = [j for j, t in enumerate(order[k + n]) if t["text"] == '"']
                if marks:
                    if len(marks) == 1 and (marks[0] >= len(order[k + n]) - 3):
                        run = order[k : k + n + 1]
                    break
        if run:
            words = [t for s in run for t in s]
            speaker = (lead["speaker_span"]["start"], lead["speaker_span"]["end"]) if lead["speaker_span"] else None
            out.append(make(text, _span(words), speaker, None, len(words), "QCQ", True))
            k += len(run)
        else:
            k += 1
    return out


def heuristic_quotes(text: str, tokens: list[dict], opening: str = '"', closing: str = '"') -> list[dict]:
    """Text between quotation marks with the nearest verb (up to 4 tokens before, then 5 after) and its subject.

    On either side the search ends at a full stop or a straight quotation mark.
    """
    out, at = [], None
    nearby = lambda run: next((run[:k] for k, x in enumerate(run) if x["text"] in (".", '"')), run)
    for t in tokens:
        if at is None:
            if t["text"] == opening:
                at = t["i"]
        elif t["text"] == closing:
            inner = tokens[at + 1 : t["i"]]
            if MIN_TOKENS < len(inner) < MAX_TOKENS:
                near = nearby(tokens[max(0, at - 4) : at][::-1]) + nearby(tokens[t["i"] + 1 : t["i"] + 6])
                verb = next((v for v in near if v["pos"] == "VERB" and v["text"].lower() not in NOT_QUOTE_VERBS), None)
                subject = next((s for s in tokens if verb and s["head"] == verb["i"] and s["dep"] == "nsubj"), None)
                speaker = _span(subtree(tokens, subject["i"])) if subject else None
                out.append(make(text, (tokens[at]["start"], t["end"]), speaker, (verb["start"], verb["end"]) if verb else None, len(inner), "Heuristic"))
            at = None
    return out


def drop_overlaps(quotes: list[dict]) -> list[dict]:
    """Quotes of four words or more that overlap no earlier kept one; order is priority."""
    kept: list[dict] = []
    for q in quotes:
        a, b = q["quote_span"]["start"], q["quote_span"]["end"]
        if len(q["quote"].split(" ")) >= MIN_WORDS and not any(min(b, k["quote_span"]["end"]) > max(a, k["quote_span"]["start"]) for k in kept):
            kept.append(q)
    return kept


def english_quotes(text: str, tokens: list[dict], verbs: set[str] = VERBS_EN) -> list[dict]:
    first = syntactic_quotes(text, tokens, verbs) + according_to_quotes(text, tokens)
    return drop_overlaps(first + floating_quotes(text, tokens, first) + heuristic_quotes(text, tokens))


def guillemet_quotes(text: str, tokens: list[dict], verbs: set[str] = VERBS_FR, window: int = 50) -> list[dict]:
    """French direct quotes of five tokens or more between guillemets; the verb is sought after, then before; the speaker is the person beside it."""
    out, at = [], None
    for t in tokens:
        if t["text"] == "«":
            at = t["i"]
        elif t["text"] == "»" and at is not None:
            inner = tokens[at + 1 : t["i"]]
            if len(inner) >= 5:
                stop = lambda run: run[: next((k for k, x in enumerate(run) if x["text"] in ".?"), len(run))]
                after = stop(tokens[t["i"] + 1 : t["i"] + 1 + window])
                before = stop(tokens[max(0, at - window) : at][::-1])[::-1]
                floating = not any(re.match(r"\w", x["text"]) for x in before + after)
                verb = next((v for side in (after, before) for v in side if v["text"].lower() in verbs), None)
                people: list[list[dict]] = []
                for x in before + after:
                    if x["ent"] == "PERSON":
                        if people and people[-1][-1]["i"] == x["i"] - 1:
                            people[-1].append(x)
                        else:
                            people.append([x])
                speaker = min(people, key=lambda p: abs(p[0]["i"] - (verb["i"] if verb else t["i"])), default=None)
                parts = sorted([((at + t["i"]) / 2, "C"), *([(verb["i"], "V")] if verb else []), *([(speaker[0]["i"], "S")] if speaker else [])])
                kind = "Q" + "".join(x for _, x in parts) + "Q" if not verb and not speaker else "".join("QCQ" if x == "C" else x for _, x in parts)
                out.append(make(text, (tokens[at]["start"], t["end"]), _span(speaker) if speaker else None, (verb["start"], verb["end"]) if verb else None, len(inner), kind, floating or speaker is None))
            at = None
    return out


def selon_quotes(text: str, tokens: list[dict]) -> list[dict]:
    """French 'selon X': the noun phrase up to the next comma speaks, the rest of the sentence of five tokens or more is the quote."""
    out = []
    for t in tokens:
        if t["text"].lower() != "selon":
            continue
        sent = [x for x in tokens if x["sent"] == t["sent"]]
        after = [x for x in sent if x["i"] > t["i"]]
        stop = next((k for k, x in enumerate(after) if x["text"] in ",.;"), len(after))
        speaker, tail = after[:stop], [x for x in after[stop + 1 :] if x["text"] not in ".;"]
        head = [x for x in sent if x["i"] < t["i"] and x["text"] != ","]
        quote = tail if len(tail) >= 5 else head
        if speaker and len(quote) >= 5:
            out.append(make(text, _span(quote), _span(speaker), (t["start"], t["end"]), len(quote), "SVC" if quote is tail else "CVS"))
    return out


def extract(articles: DataFrame, rule: Callable[[str, list[dict]], list[dict]], parser: Callable[[str], list[dict]] = default_tokens, key: str = "_id", text: str = "body") -> DataFrame:
    """(key, quotes): ``rule`` over every text of at most 20,000 characters, one pass in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quotes = pa.array([rule(t, parser(t)) for t in batch.column("t").to_pylist()], pa.list_(KINDS))
            yield pa.RecordBatch.from_arrays([batch.column("k"), quotes], ["k", "quotes"])

    rows = articles.where(F.length(text).between(1, MAX_BODY)).select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(run, f"k {kind}, quotes array<{DDL}>").withColumnRenamed("k", key)


def type_shares(quotes: DataFrame) -> DataFrame:
    """(quote_type, n, percent) of rows with a column quote_type."""
    from pyspark.sql import Window

    counts = quotes.groupBy("quote_type").agg(F.count("*").alias("n"))
    return counts.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 3))


def summary(rows: DataFrame, counters: list[str], total: str) -> DataFrame:
    """(counter, total, mean, median, std, share): statistics of per-document counters; share is of the sum of ``total``."""
    long = rows.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys([*counters, total])]).unpivot([], counters, "counter", "value") if total in counters else rows.select(*[F.col(c).cast("double").alias(c) for c in counters]).unpivot([], counters, "counter", "value")
    whole = rows.agg(F.sum(total).cast("double").alias("whole"), F.lit(1).alias("k"))
    out = long.groupBy("counter").agg(F.sum("value").alias("total"), F.avg("value").alias("mean"), F.percentile("value", F.lit(0.5)).alias("median"), F.stddev_samp("value").alias("std"), F.lit(1).alias("k"))
    return out.join(F.broadcast(whole), "k").select("counter", "total", "mean", "median", "std", F.try_divide("total", "whole").alias("share"))

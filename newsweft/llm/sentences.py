"""Sentence boundaries across languages and scripts (problem 3).

A semi-Markov dynamic program chooses whole sentence spans of every line. Places after a run of
sentence marks (of any script), and spaces in scripts without such marks, are where a span may
end. A span's score adds up what its length, its opening word, its closing word and mark say,
and whether it leaves a quotation open or cuts a quotation from the clause that names its
speaker. The best segmentation is found over all spans of up to ``MAX_MARKS`` marks.

For scripts that write neither marks nor spaces between words (Thai, Khmer, Lao), which words
open a sentence is learned from the openings of all lines of the corpus; the table has at most
``MAX_OPENINGS`` rows of five characters, those on a share of lines.

Cases: null, empty and blank bodies have no sentence; a line without marks is one unit; a bullet
or a label belongs to what follows; surrounding white space is left out; repeated ids count
once; very long lines are handled whole; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsweft.llm.lookalike import fold_text

MAX_MARKS, MAX_OPENINGS = 64, 400

#: Abbreviations by what follows them, and words that open sentences, folded.
TITLES = set("mr mrs ms mx dr prof rev sgt lt gov sen rep gen col capt cpl cst insp supt hon st ste mt coun pres mm mme mmes mlle mlles mgr pr cllr det maj fr sr adm cmdr डॉ श्री".split())
CASED_TITLES = {"M", "Me", "Mes", "ME", "MES"}
BEFORE_NUMBER = set("no nos nº sec art arts fig figs vol ch chap pp p n para par § al v".split())
NEVER = set("e.g i.e cf vs viz c.-à-d p.ex eg ie ex bros".split())
COMPANY = set("inc ltd corp co bros cie ltée llc plc limited".split())
CLOCK = {"a.m", "p.m", "am", "pm"}
SOFT = COMPANY | CLOCK | set("u.s u.k u.n e.u d.c b.c p.e.i jr sr etc approx dept est ave blvd jan feb mar apr jun jul aug sept sep oct nov dec janv févr avr juil déc tel".split())
DAYS = set("monday tuesday wednesday thursday friday saturday sunday lundi mardi mercredi jeudi vendredi samedi dimanche est edt cst cdt mst mdt pst pdt ast adt nst ndt".split())
OPENERS = set(
    "a an the it its he she they we i you this that these those there here at on in of for from by if why what who how when where while whether until since after before although though "
    "because no not neither nearly still snow some all any many most ask under until rather despite according officials prices home costs travellers engineers seven "
    "le la les l un une des du de d il elle ils elles on nous vous je ce cet cette ces à au aux en dans sur pour par chez depuis selon quel quelle faut ni mais près au après avant vérification une tous accept manage learn reject you your see".split()
)
SPEECH = re.compile(r"\b(?:said|says|say|asked|asks|told|added|adds|argued|argues|explained|explains|insisted|insists|noted|notes|recalled|recalls|warned|warns|replied|wrote|writes|claimed|stated|testified|according|dit|affirme|ajoute|explique|précise|soutient|déplore|raconte|demande|répond|écrit|confie)\b")

_CANDIDATE = re.compile(r"(?:[.!?…。！？।؟]+)[\"”»」』’)\]）]*(?:[  ]»)?")
_PREVIOUS = re.compile(r"\S{1,40}$")
_NEXT = re.compile(r"[\s\"“«「『‘(\[（•»-]*([^\W\d_]+|\d+)?")
_PAIRS = {"“": "”", "«": "»", "「": "」", "『": "』", "（": "）", "(": ")", "„": "“"}
_QUOTES = re.compile("[\"“”«»「」『』（）()„]")
_OPENING = "\"“«「『‘(（["
_SPACELESS = re.compile("[฀-๿຀-໿ក-៿က-႟]")
_GAP = re.compile(r"\s+")


def quotations(line: str) -> list[tuple[int, int]]:
    """(start, end) of the quotations and brackets that close within the line; unpaired marks are ignored."""
    spans, open_marks, straight = [], [], -1
    for m in _QUOTES.finditer(line):
        c, at = m[0], m.start()
        if c == '"':
            if straight < 0:
                straight = at
            else:
                spans.append((straight, at))
                straight = -1
        elif c == "»" and not any(x[0] == "«" for x in open_marks):
            continue
        elif open_marks and c == _PAIRS[open_marks[-1][0]]:
            spans.append((open_marks.pop()[1], at))
        elif c in _PAIRS:
            open_marks.append((c, at))
        else:
            for k in range(len(open_marks) - 1, -1, -1):
                if _PAIRS[open_marks[k][0]] == c:
                    spans.append((open_marks[k][1], at))
                    del open_marks[k:]
                    break
    return sorted(spans)


def _closing(previous: str, mark: str, after: str, capital: bool, quoted: bool, cased: bool) -> float:
    """What the word and mark before a place, and the word after it, say for a sentence end."""
    word = previous.lstrip("\"“«「『‘(（[•-–—'").rstrip(".")
    low = fold_text(word)
    low = low.rsplit("’", 1)[-1].rsplit("'", 1)[-1]
    next_low = fold_text(after)
    opens = next_low in OPENERS
    number = after[:1].isdigit()
    if mark[0] in "。！？।؟":
        return 4.0
    if mark[0] in "!?":
        return 3.0 if capital or quoted or not cased or number else 0.5
    if "…" in mark or mark.startswith(".."):
        return (2.5 if capital or quoted else -3.0) if cased else (1.0 if quoted else -1.5 + opens * 0.4)
    if low in NEVER or (low in COMPANY and next_low in COMPANY):
        return -6.0
    if number and low in BEFORE_NUMBER:
        return -6.0
    if low in BEFORE_NUMBER and next_low == "ex":
        return -6.0
    if low in TITLES or word in CASED_TITLES:
        return -6.0 if not quoted and after else -1.0
    if len(low) == 1 and low.isalpha():
        return -3.0 if not quoted else 0.5
    if low in SOFT or (low.count(".") and low.replace(".", "").isalpha() and len(low) <= 7):
        if quoted:
            return 2.0
        if low in CLOCK and next_low in DAYS:
            return -6.0
        if cased:
            return (1.0 + opens) if capital else -4.0
        if low in COMPANY and next_low in ("of", "and", "de", "du", "et"):
            return -4.0
        return (-0.6 if low in COMPANY else -1.0) + 1.6 * opens
    if cased:
        return 4.0 if capital or quoted else 1.0 if number else -3.0
    return 2.5


def _length(line: str, start: int, end: int) -> float:
    """What the length of a span says: hardly any sentence has only one to three words."""
    size = end - start
    if size > 24:
        return 0.0 if size < 600 else -0.002 * (size - 600)
    words = len(line[start:end].split())
    return (-2.0, -1.5, -1.0, -0.7)[words] if words < 4 else 0.0


def split_line(line: str, openings: frozenset[str] = frozenset()) -> list[tuple[int, int]]:
    """The sentences of one line as (start, end)."""
    begin, stop = len(line) - len(line.lstrip()), len(line.rstrip())
    if begin >= stop:
        return []
    spaceless = bool(openings) and _SPACELESS.search(line) is not None
    places: list[tuple[int, float]] = []
    quotes = None
    cased = None
    for m in _CANDIDATE.finditer(line, begin, stop):
        at = m.end()
        if at >= stop:
            continue
        if quotes is None:
            quotes = quotations(line)
            cased = any(map(str.islower, line)) and any(map(str.isupper, line)) or not any(map(str.isalpha, line))
            starts = {a for a, _ in quotes}
            ends = {b for _, b in quotes}
        marks = len(m[0]) - len(m[0].lstrip(".!?…。！？।؟"))
        while at > m.start() + marks and line[at - 1] in "\"'’" and at - 1 in starts:
            at -= 1
        spaced = line[at].isspace()
        follow = _NEXT.match(line, at)
        after = follow[1] or ""
        first = line[at:follow.end()].lstrip()[:1] if follow.end() > at else line[at : at + 1]
        quoted = bool(first) and first in _OPENING
        capital = after[:1].isupper() or (bool(after) and not after[0].isdigit() and not after[0].islower() and not after[0].isupper())
        mark = m[0][:marks]
        head = line[max(begin, m.start() - 40) : m.start() + (1 if mark == "." else 0)]
        previous = (_PREVIOUS.search(head) or [""])[0].rstrip(".") if head else ""
        if not spaced and mark[0] in ".!?…؟":
            tail = previous.lstrip("\"“«(")
            if not (len(tail) > 1 and (tail[-1].isalpha() or tail[-1] == "²" or (tail[-1].isdigit() and capital)) and "." not in tail and (quoted or (after and capital and cased) or (not cased and fold_text(after) in OPENERS))):
                if not (mark[0] in "!?؟" and (quoted or capital)) and not (at > m.start() + marks and capital):
                    continue
        if m.start() == begin + len(previous) and previous.strip("()").isdigit() and mark == ".":
            continue
        score = _closing(previous, mark, after, capital, quoted, cased)
        inside = False
        for a, b in quotes:
            if a < at <= b:
                inside = True
                break
        if inside:
            score -= 9.0
        elif at > m.start() + marks and (at - 1) in ends:
            a = max(x for x, b in quotes if b == at - 1)
            lead = line[:a].rstrip()
            fresh = not lead or lead[-1] in ".!?…。！？।؟»”」" or _SPACELESS.match(lead[-1]) is not None and len(lead) < a
            if line[a] in "(（":
                pass
            elif fresh and not quoted:
                rest = line[at : at + 60]
                latin = bool(after) and after[0].isascii()
                if not latin or after[0].islower() and cased or SPEECH.search(rest.lower()):
                    score -= 9.0
            elif not fresh and (first == "と" or after.startswith("と")):
                score -= 9.0
        elif first in ("と",):
            score -= 9.0
        places.append((at, score))
    if spaceless:
        if quotes is None:
            quotes = quotations(line)
        for m in _GAP.finditer(line, begin, stop):
            at = m.start()
            tail, head = line[at - 1], line[m.end() : m.end() + 5]
            if any(a < at <= b for a, b in quotes) or any(b == at - 1 for _, b in quotes):
                continue
            if tail.isdigit() or tail in ":：" or not (_SPACELESS.match(tail) or tail in ".!?"):
                continue
            if head[:1] in "“\"«" or head in openings:
                places.append((at, 3.0))
        places.sort()
    if not places:
        return [(begin, stop)]
    cuts = [(begin, 0.0), *places, (stop, 0.0)]
    best, back = [0.0], [0]
    for j in range(1, len(cuts)):
        end, gain = cuts[j]
        top, arg = -1e18, j - 1
        for i in range(max(0, j - MAX_MARKS), j):
            score = best[i] + gain + _length(line, cuts[i][0], end)
            if score > top + 1e-9:
                top, arg = score, i
        best.append(top)
        back.append(arg)
    out, j = [], len(cuts) - 1
    while j:
        i = back[j]
        a, b = cuts[i][0], cuts[j][0]
        text = line[a:b]
        a += len(text) - len(text.lstrip())
        b -= len(text) - len(text.rstrip())
        if a < b:
            out.append((a, b))
        j = i
    return out[::-1]


def split_body(body: str | None, openings: frozenset[str] = frozenset()) -> tuple[list[int], list[int]]:
    """Starts and ends of all sentences, in code points from the start of the body."""
    starts: list[int] = []
    ends: list[int] = []
    at = 0
    for line in (body or "").split("\n"):
        for a, b in split_line(line, openings):
            starts.append(at + a)
            ends.append(at + b)
        at += len(line) + 1
    return starts, ends


def learned_openings(articles: DataFrame, text_col: str = "body") -> frozenset[str]:
    """First five characters of lines in scripts without marks and spaces, those on at least one in 2,000 of such lines and more than one line."""
    lines = articles.where(F.col(text_col).rlike("[\\u0e00-\\u0eff\\u1780-\\u17ff\\u1000-\\u109f]")).select(F.explode(F.split(F.col(text_col), "\n")).alias("line"))
    heads = lines.select(F.substring(F.regexp_replace("line", "^[\\s“\"«•-]+", ""), 1, 5).alias("head")).where(F.col("head").rlike("^[\\u0e00-\\u0eff\\u1780-\\u17ff\\u1000-\\u109f]{5}"))
    counted = heads.groupBy("head").count()
    total = counted.agg(F.sum("count")).first()[0] or 0
    rows = counted.where(F.col("count") >= max(2, total / 2000)).orderBy(F.desc("count"), "head").limit(MAX_OPENINGS).collect()
    return frozenset(r["head"] for r in rows)


def _sentences(openings: frozenset[str]):
    kinds = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [split_body(b, openings) for b in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([s for s, _ in split], kinds), pa.array([e for _, e in split], kinds)], ["id", "starts", "ends"])

    return run


def sentences(rows: DataFrame, id_col: str = "_id", text_col: str = "body") -> DataFrame:
    """(id, sent_start, sent_end) of every sentence of every text."""
    openings = learned_openings(rows, text_col)
    texts = rows.where(F.col(id_col).isNotNull() & (F.length(text_col) > 0)).select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    split = texts.mapInArrow(_sentences(openings), "id string, starts array<int>, ends array<int>")
    split = split.groupBy("id").agg(F.first("starts").alias("starts"), F.first("ends").alias("ends"))
    pairs = split.select("id", F.explode(F.arrays_zip("starts", "ends")).alias("s"))
    return pairs.select(F.col("id").alias(id_col), F.col("s.starts").alias("sent_start"), F.col("s.ends").alias("sent_end"))


def found(articles: DataFrame) -> DataFrame:
    return sentences(articles)

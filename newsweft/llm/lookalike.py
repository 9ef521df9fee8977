"""Visually identical text in one consistent form (problem 4).

Look-alike relations between strings and code points (full-width forms and ligatures with
their parts, letters with combining accents and the composed letters, kinds of spaces, of
hyphens, invisible characters and nothing, letters of related alphabets) are closed to
transitive classes by union-find. The member of a class that is most frequent in the corpus
becomes its representative; ordinary (normalised) forms begin with ``PRIOR`` occurrences, so that they win where a
corpus says little, and ties go to ASCII. A text is rewritten greedily, leftmost and
longest first, by an Aho-Corasick automaton over all other members. Members that are letters
of another alphabet are rewritten only inside words that mix alphabets, towards the alphabet
most of the word's letters have; words wholly in one alphabet stay.

Cases: null stays null; empty, blank text unchanged; very long texts are handled whole;
repeated keys count once; null entries of an array keep their place; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Letters of other alphabets and the Latin letters they look like.
CONFUSABLE = dict(
    zip(
        "аеорсухіјѕһԁԛԝӏѵАВЕКМНОРСТУХІЈЅԌԚԜѴ" + "οανρυικϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ" + "օոսհցզՕՍՏԼ" + "ᎠᎡᎢᎪᎫᎬᎳᎷᎻᏀᏃᏙᏚᏞᏟᏢᏦᏴ",
        "aeopcyxijshdqwlvABEKMHOPCTYXIJSGQWV" + "oavpuikcjABEZHIKMNOPTYXCJ" + "onuhgqOUSL" + "DRTAJEWMHGZVSLCPKB",
    )
)
#: Spaces, hyphens and invisible characters other than the ordinary ones.
SPACES = "               　"
HYPHENS = "‐‑‒⁃﹣－"
INVISIBLE = "­͏؜ᅟᅠ឴឵᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩︎️﻿"

#: Occurrences that ordinary forms begin with when representatives are chosen.
PRIOR = 1000

#: Lower-case forms of capitals that look alike, for comparisons that ignore case.
_FOLD = {c: t.lower() for c, t in CONFUSABLE.items()} | {c.lower(): t.lower() for c, t in CONFUSABLE.items() if c.isupper() and c.lower() not in CONFUSABLE}
_FOLD |= dict.fromkeys(SPACES, " ") | dict.fromkeys(HYPHENS, "-") | dict.fromkeys(INVISIBLE, "")
_FOLDABLE = re.compile("[" + re.escape("".join(_FOLD)) + "]")
_WORD = re.compile(r"[^\W_]+")


def fold_text(text: str) -> str:
    """The form in which texts are compared: look-alikes united whatever their alphabet, invisible characters gone, lower case."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKC", text)
    if _FOLDABLE.search(text):
        text = unicodedata.normalize("NFC", _FOLDABLE.sub(lambda m: _FOLD[m[0]], text))
    return text.lower()


def words(text: str) -> list[str]:
    """Runs of letters or digits of the folded text."""
    return _WORD.findall(fold_text(text))


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a: str, b: str) -> None:
        self.parent[self.find(a)] = self.find(b)

    def members(self) -> dict[str, list[str]]:
        groups: dict[str, list[str]] = {}
        for x in list(self.parent):
            groups.setdefault(self.find(x), []).append(x)
        return groups


def _alphabet(c: str) -> str:
    """latin, greek, cyrillic, armenian, cherokee or '' for every other character."""
    n = ord(c)
    if n < 0x80:
        return "latin" if c.isalpha() else ""
    if 0xC0 <= n <= 0x24F or 0x1E00 <= n <= 0x1EFF or 0xFB00 <= n <= 0xFB06 or 0xFF21 <= n <= 0xFF5A or 0x250 <= n <= 0x2AF:
        return "latin" if c.isalpha() else ""
    if 0x370 <= n <= 0x3FF or 0x1F00 <= n <= 0x1FFF:
        return "greek" if c.isalpha() else ""
    if 0x400 <= n <= 0x52F:
        return "cyrillic" if c.isalpha() else ""
    if 0x13A0 <= n <= 0x13FF or 0xAB70 <= n <= 0xABBF:
        return "cherokee"
    return "armenian" if 0x530 <= n <= 0x58F and c.isalpha() else ""


@lru_cache(maxsize=1)
def relations() -> list[tuple[str, str]]:
    """Pairs of strings that look alike."""
    pairs = [(c, " ") for c in SPACES] + [(c, "-") for c in HYPHENS] + [(c, "") for c in INVISIBLE]
    # full-width digits and letters, joined Latin, Armenian and Arabic letters, letter symbols, half-width kana and Hangul, mathematical letters and digits
    ranges = [(0xFF10, 0xFF19), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A), (0xFB00, 0xFB06), (0xFB13, 0xFB17), (0xFB50, 0xFDFB), (0xFE70, 0xFEFC), (0x2100, 0x214F), (0xFF66, 0xFFDC), (0x1D400, 0x1D7FF)]
    for low, high in ranges:
        for n in range(low, high + 1):
            plain = unicodedata.normalize("NFKC", chr(n))
            if plain != chr(n) and unicodedata.category(chr(n))[0] in "LN":
                pairs.append((chr(n), plain))
                if 0xFF66 <= n <= 0xFF9D:  # half-width kana carry their voice marks behind them
                    pairs += [(chr(n) + mark, voiced) for mark in "ﾞﾟ" if len(voiced := unicodedata.normalize("NFKC", chr(n) + mark)) == 1]
    for n in (*range(0xC0, 0x3100), *range(0xAC00, 0xD7A4)):
        parts = unicodedata.normalize("NFD", chr(n))
        if len(parts) > 1 and unicodedata.normalize("NFC", parts) == chr(n) and unicodedata.category(chr(n))[0] == "L":
            pairs.append((parts, chr(n)))
    return pairs + list(CONFUSABLE.items())


def _ranges(chars: Iterable[str]) -> str:
    """The characters as ranges of a pattern: one by one, those beyond U+FFFF would all be tried on every character of a text."""
    runs: list[list[int]] = []
    for n in sorted(map(ord, chars)):
        if runs and n <= runs[-1][1] + 1:
            runs[-1][1] = n
        else:
            runs.append([n, n])
    return "".join(f"\\U{low:08x}-\\U{high:08x}" for low, high in runs)


class Rewriter:
    """The automaton for given corpus counts of strings."""

    def __init__(self, counts: dict[str, int] | None = None) -> None:
        import ahocorasick

        counts = counts or {}

        def often(x: str) -> int:
            plain = len(x) > 1 and not any(map(unicodedata.combining, x))
            seen = min(counts.get(c, 0) for c in x) if plain else counts.get(x, 0)
            return seen + PRIOR * (unicodedata.normalize("NFKC", x) == x)

        classes = Classes()
        for a, b in relations():
            classes.union(a, b)
        self.to: dict[str, str] = {}
        self.across: set[str] = set()
        self.by_class: dict[str, dict[str, str]] = {}
        for group in classes.members().values():
            rank = lambda x: (-often(x), not x.isascii(), len(x), x)
            best = "" if "" in group else min(group, key=rank)
            own = {}
            for x in sorted(group, key=rank):
                if x and (a := _alphabet(x[0])):
                    own.setdefault(a, x)
            for x in group:
                if x == best:
                    continue
                if len(own) > 1 and len(x) == 1 and _alphabet(x) not in ("", "latin"):
                    self.across.add(x)
                    self.by_class[x] = own
                elif len(own) > 1 and x.isascii() and x:
                    self.by_class[x] = own
                    self.across.add(x)
                else:
                    near = own.get(_alphabet(unicodedata.normalize("NFKC", x)[:1] or " "), best) if x else best
                    if near != x:
                        self.to[x] = near
            if len(own) > 1 and best:
                self.by_class[best] = own
        self.automaton = ahocorasick.Automaton()
        for x, target in self.to.items():
            self.automaton.add_word(x, (x, target))
        self.automaton.make_automaton()
        foreign = "Ͱ-ϿЀ-ԯ԰-֏ἀ-῿Ꭰ-᏿ꭰ-ꮿ"
        self.foreign = re.compile(f"[{foreign}]")
        self.letters = re.compile(r"[^\W\d_]+")
        self.ascii_stays = not any(map(str.isascii, self.to))
        single = {x[0] for x in self.to if not x[0].isascii() or len(x) == 1} | {x[1] for x in self.to if len(x) > 1 and unicodedata.combining(x[1])}
        self.suspect = re.compile("[" + _ranges(single) + foreign + "]")

    def _word(self, m: re.Match) -> str:
        word = m[0]
        seen = Counter(filter(None, map(_alphabet, word)))
        if len(seen) < 2:
            return word
        sure = Counter(a for c in word if (a := _alphabet(c)) and c not in self.by_class)
        home = max(seen, key=lambda a: (sure[a], seen[a], a == "latin"))
        return "".join(self.by_class[c].get(home, c) if c in self.by_class and _alphabet(c) not in ("", home) else c for c in word)

    def plain(self, text: str) -> bool:
        """Whether nothing in the text can change."""
        return self.ascii_stays and text.isascii() or not self.suspect.search(text)

    def rewrite(self, text: str) -> str:
        if self.plain(text):
            return text
        out, at = [], 0
        for end, (x, target) in self.automaton.iter_long(text):
            start = end - len(x) + 1
            out += (text[at:start], target)
            at = end + 1
        text = "".join(out) + text[at:] if out else text
        if self.foreign.search(text):
            text = self.letters.sub(self._word, text)
        return text


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    strange = re.compile(r"[^\x00-\x7f]")
    marked = re.compile("[^\\W\\d_][\u0300-\u036f\u3099\u309a]+|[\u1100-\u1112][\u1161-\u1175][\u11a8-\u11c2]?|[\uff66-\uff9d][\uff9e\uff9f]")
    ascii_counts, others = np.zeros(128, dtype=np.int64), Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            if not text:
                continue
            ascii_counts += np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)[:128]
            if not text.isascii():
                others.update(strange.findall(text))
                others.update(marked.findall(text))
    for n in np.flatnonzero(ascii_counts):
        others[chr(n)] += int(ascii_counts[n])
    yield pa.RecordBatch.from_pydict({"s": list(others), "n": list(others.values())}, pa.schema([("s", pa.string()), ("n", pa.int64())]))


def corpus_counts(texts: DataFrame) -> dict[str, int]:
    """Counts of code points and accented strings over the column ``text``; the result is bounded by Unicode, not by the corpus."""
    known = {x for pair in relations() for x in pair if x}
    counts = texts.mapInArrow(_count, "s string, n long").groupBy("s").agg(F.sum("n").alias("n"))
    kept = counts.join(F.broadcast(texts.sparkSession.createDataFrame([(x,) for x in sorted(known)], "s string")), "s", "left_semi")
    return {r["s"]: r["n"] for r in kept.collect()}


def _strange_items(counts: dict[str, int]):
    kinds = pa.schema([("_id", pa.string()), ("body", pa.list_(pa.int32())), ("people", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewriter = Rewriter(counts)
        changed = lambda items: [n for n, x in enumerate(items, 1) if x and rewriter.rewrite(x) != x]
        for batch in batches:
            bodies = [[] if b is None or rewriter.plain(b) else changed(b.split("\n")) for b in batch.column("body").to_pylist()]
            people = [[] if p is None else changed(p) for p in batch.column("people").to_pylist()]
            yield pa.RecordBatch.from_pydict({"_id": batch.column("_id").to_pylist(), "body": bodies, "people": people}, kinds)

    return run


def found(articles: DataFrame) -> DataFrame:
    """(_id, field, item_no): lines of body and entries of people that the rewriting changes."""
    texts = articles.select(F.col("body").alias("text")).where("text is not null")
    names = articles.select(F.explode("people").alias("text")).where("text is not null")
    counts = corpus_counts(texts.unionByName(names))
    rows = articles.select("_id", "body", "people").mapInArrow(_strange_items(counts), "_id string, body array<int>, people array<int>")
    rows = rows.where("size(body) + size(people) > 0").groupBy("_id").agg(F.first("body").alias("body"), F.first("people").alias("people"))
    items = lambda field: F.transform(field, lambda n: F.struct(F.lit(field).alias("field"), n.alias("item_no")))
    return rows.select("_id", F.explode(F.concat(items("body"), items("people"))).alias("x")).select("_id", "x.field", "x.item_no")


def canonicalise(rows: DataFrame, column: str, counts: dict[str, int] | None = None) -> DataFrame:
    """``rows`` with the text column in one consistent form."""
    counts = corpus_counts(rows.select(F.col(column).alias("text")).where("text is not null")) if counts is None else counts

    @F.pandas_udf("string")
    def rewritten(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rewriter = Rewriter(counts)
        for batch in texts:
            yield batch.map(lambda t: t if t is None else rewriter.rewrite(t))

    return rows.withColumn(column, rewritten(F.col(column)))


def canonical_lines(lines: Iterable[str]) -> list[str]:
    rewriter = Rewriter()
    return [rewriter.rewrite(x) for x in lines]

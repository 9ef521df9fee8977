"""Variant spellings of the names of people and organisations (problem 1).

Every distinct string is folded (look-alikes, accents, case), freed of bylines, roles, titles
and possessives, and read as a person (given name, surname), a person with initials, an
organisation or an acronym. Strings with one reading share a node. Nodes meet in blocks of
phonetic codes of their tokens in sorted or surname order, are compared by Jaro-Winkler and
edit distance plus a table of nicknames, and accepted pairs are clustered by connected
components. Forms with initials, nicknames that are short for several names, and acronyms would
tie different entities together, so they join a cluster afterwards, and only if one cluster
alone fits.

Which tokens are given names is learned from all strings: those that stand before at least
``MIN_SURNAMES`` different surnames, and not much fewer than other given names do. Two such names
never count as misspellings of each other.

Cases: null and empty strings, and words such as "Staff" that name nobody, are in no pair;
repeated strings count once; a component of one string gives no pair; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsweft.llm.components import connected_components
from newsweft.llm.lookalike import fold_text
from newsweft.session import cut_lineage

MIN_SURNAMES = 3
#: A given name stands before at least this share of the surnames that the 20th most common one stands before.
KNOWN_SHARE = 0.07

#: Nicknames and the names they stand for.
NICKNAMES = {
    "abby": "abigail", "al": "albert alan alexander", "alex": "alexander alexandra", "andy": "andrew andre", "annie": "anne", "ben": "benjamin", "beth": "elizabeth", "betty": "elizabeth",
    "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert", "cathy": "catherine", "charlie": "charles", "chris": "christopher christine christian", "chuck": "charles",
    "dan": "daniel", "danny": "daniel", "dave": "david", "deb": "deborah", "debbie": "deborah", "dick": "richard", "don": "donald", "ed": "edward", "eddie": "edward", "eliza": "elizabeth",
    "frank": "francis franklin", "fred": "frederick", "freddie": "frederick", "gen": "genevieve", "gene": "eugene", "ginny": "virginia", "greg": "gregory", "hank": "henry", "harry": "henry harold",
    "jack": "john", "jackie": "jacqueline", "jake": "jacob", "jamie": "james", "jeff": "jeffrey", "jen": "jennifer", "jenny": "jennifer", "jim": "james", "jimmy": "james", "joe": "joseph",
    "johnny": "john", "josh": "joshua", "judy": "judith", "kate": "katherine catherine", "kathy": "katherine", "katie": "katherine", "kay": "katherine", "ken": "kenneth", "kit": "christopher katherine",
    "larry": "lawrence", "len": "leonard", "lenny": "leonard", "leo": "leonard", "liz": "elizabeth", "lizzie": "elizabeth", "lou": "louis louise", "maggie": "margaret", "mandy": "amanda", "marge": "margaret",
    "matt": "matthew", "max": "maxwell", "meg": "margaret", "mick": "michael", "mickey": "michael", "mike": "michael", "mitch": "mitchell", "ned": "edward", "nick": "nicholas", "pam": "pamela",
    "pat": "patricia patrick", "patty": "patricia", "peg": "margaret", "peggy": "margaret", "pete": "peter", "phil": "philip", "pip": "philippa philip", "pippa": "philippa", "ray": "raymond",
    "rick": "richard frederick", "ricky": "richard", "rob": "robert", "robbie": "robert", "ron": "ronald", "sam": "samuel samantha", "sandra": "alexandra", "sandy": "alexandra", "lexi": "alexandra", "sasha": "alexandra",
    "steve": "steven stephen", "sue": "susan", "susie": "susan", "suzie": "susan", "ted": "edward theodore", "teddy": "edward theodore", "theo": "theodore", "tim": "timothy", "timmy": "timothy", "tom": "thomas tomas",
    "tony": "anthony", "tori": "victoria", "trish": "patricia", "tricia": "patricia", "val": "valerie", "vic": "victor victoria", "vicky": "victoria", "vicki": "victoria", "will": "william", "willy": "william",
    "zach": "zachary", "zack": "zachary", "zak": "zachary", "ange": "angela", "barb": "barbara", "cindy": "cynthia", "doug": "douglas", "gabe": "gabriel", "nat": "nathaniel natalie", "nate": "nathaniel",
}
#: Titles before names, roles after them, words of organisations, words that name nobody.
TITLES = set("mr mrs ms miss mx dr prof rev sgt lt gov sen rep hon coun cllr capt col gen maj cpl insp supt chief const mayor judge justice minister premier president m mme mlle me mgr pr dre sr sir maire mairesse ministre depute deputee conseiller conseillere dame madame monsieur".split())
ROLE = re.compile(r"(?:,|\||-|–)\s*(?:the\s+)?(?:senior\s+|special\s+)?(?:staff|columnist|reporter|editor|correspondent|journalist|journaliste|chroniqueu\w+|writer|contributor|collaborat\w+|photograph\w+|bureau|special to|for the|pour)\b.*$")
ORG_WORDS = set("corporation corp foundation fdn union federation fed institute inst commission comm authority auth association assn assoc department dept limited ltd inc council society board agency centre center college university hospital group company co committee ministry office service services network alliance league trust club bank coalition".split())
SUFFIXES = {"inc", "incorporated", "ltd", "llc", "corp", "co", "plc"}
NOBODY = set("staff newsroom redaction editor editors admin unknown null none anonymous guest nobody n a na the associated press canadian wire services".split())

_QUOTED = re.compile(r"[\"“”«»'‘’(]\s*([^\W\d_]+)\s*[\"“”«»'’)]")
_CODES = {c: d for d, cs in enumerate(("bfpvw", "cgjkqsxz", "dt", "l", "mn", "r"), 1) for c in cs}


def plain(text: str) -> str:
    """Folded, without accents, with single spaces."""
    text = "".join(c for c in unicodedata.normalize("NFD", fold_text(text)) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", text.replace("’", "'").replace("œ", "oe").replace("æ", "ae")).strip()


@lru_cache(maxsize=100_000)
def phonetic(token: str) -> str:
    """Classes of consonants in order, repeats and vowels left out."""
    out = ""
    for c in token:
        d = _CODES.get(c)
        if d and not out.endswith(str(d)):
            out += str(d)
    return out or token[:1]


def formal(given: str) -> frozenset[str]:
    """The name itself and what it may be short for."""
    return frozenset((given, *NICKNAMES.get(given, "").split()))


def edits(a: str, b: str, most: int) -> int:
    """Optimal string alignment distance, or ``most`` + 1 if it is larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[-1]


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    used, left = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                left.append(x)
                break
    m = len(left)
    if not m:
        return 0.0
    right = [y for y, u in zip(b, used) if u]
    t = sum(x != y for x, y in zip(left, right)) / 2
    jaro = (m / len(a) + m / len(b) + (m - t) / m) / 3
    start = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        start += 1
    return jaro + 0.1 * start * (1 - jaro)


def close(a: str, b: str) -> bool:
    """A misspelling: one edit (two in long words) and a high Jaro-Winkler similarity."""
    if a == b:
        return True
    short = min(len(a), len(b))
    if short < 3:
        return False
    far = edits(a, b, 1 if short < 9 else 2)
    return far <= (1 if short < 9 else 2) and jaro_winkler(a, b) >= (0.72 if far == 1 else 0.88)  # repeated letters lower it


def same_given(a: str, b: str, known: frozenset[str]) -> bool:
    x, y = a.replace("-", ""), b.replace("-", "")
    if x == y or formal(a) & formal(b) or a == b.split("-")[0] or b == a.split("-")[0]:
        return True
    if (a in known or a in NICKNAMES) and (b in known or b in NICKNAMES):
        return False
    return close(a, b)


def short_for(a: str, b: str) -> bool:
    """Abbreviations begin alike and keep the order of letters."""
    a, b = sorted((a, b), key=len)
    if len(a) < 2 or a[0] != b[0]:
        return False
    at = iter(b)
    return b.startswith(a) or (len(a) <= 4 and all(c in at for c in a))


def read_name(text: str, known: frozenset[str]) -> tuple[str, list[str]] | None:
    """(kind, parts): ('p', [given, surname]), ('i', [initials, surname]), ('o', tokens), ('a', [acronym]) or None."""
    if not text:
        return None
    t = plain(text)
    t = re.sub(r"^(?:by|par|from|de)\s+", "", t)
    t = ROLE.sub("", t).strip()
    t = re.sub(r"'s$|s'$(?<=[^\W\d_]')", "", t)
    t = re.sub(r"(?<=\w) ?, ?(?:[a-z]\.){2,}$|(?<=\w), (?:phd|md|mp|mpp|mla|qc|kc|cpa|ceo|jr\.?|sr\.?)$", "", t) if t.find(",") > 0 and " " in t[: t.find(",")] else t
    if re.fullmatch(r"(?:[a-z]\. ?){3,6}", t):
        return "a", [re.sub(r"[^a-z]", "", t)]
    words = re.findall(r"[^\W_]+", t)
    if not words or all(w in NOBODY for w in words):
        return None
    if len(words) == 1:
        bare = re.sub(r"[^\w]", "", unicodedata.normalize("NFKC", text))
        return ("a", [words[0]]) if 3 <= len(words[0]) <= 6 and bare.isupper() else ("x", words)
    org = any(w in ORG_WORDS for w in words) or (len(words) >= 4 and not any(len(w) == 1 or w in TITLES for w in words) and '"' not in t and "-" not in t) or re.search(r" of |\(", t)
    if org:
        inner = re.search(r"\(([^)]*)\)", t)
        place: list[str] = []
        if inner:
            t = t.replace(inner[0], " ")
            place = re.findall(r"[^\W_]+", inner[1])
        tokens = [w for w in re.findall(r"[^\W_]+", re.sub(r"^the ", "", t))]
        if place and not (len(place) == 1 and len(place[0]) == len(tokens) and all(a == b[0] for a, b in zip(place[0], tokens))):
            tokens = place + tokens
        if "of" in tokens[1:]:
            at = tokens.index("of", 1)
            tokens = tokens[at + 1 :] + tokens[:at]
        while len(tokens) > 2 and tokens[-1] in SUFFIXES and (tokens[-1] != "co" or len(tokens) > 3) and not (tokens[-1] in ("corp", "ltd") and len(tokens) <= 4):
            tokens.pop()
        return "o", tokens
    t = _QUOTED.sub(" ", t).strip()
    while (m := re.match(r"([a-z]+)\.? ", t)) and m[1] in TITLES and (m[0].endswith(". ") or len(m[1]) > 1) and len(t.split()) > 2:
        t = t[m.end() :]
    if "," in t:
        surname, _, rest = (x.strip() for x in t.partition(","))
        order = [*rest.split(), surname.replace(" ", "")]
    else:
        order = t.split()
    order = [w for w in (re.sub(r"[^\w.'-]", "", w) for w in order) if w.strip(".'-")]
    if len(order) < 2:
        return "x", order
    first, last = order[0], order[-1].strip(".-'")
    if re.fullmatch(r"[a-z]\.?(?:-[a-z]\.?)*", first):
        return "i", ["".join(re.findall(r"[a-z]", first)), last.replace("'", "")]
    first = first.strip(".'-")
    if "," not in t and len(order) == 2 and first not in known and first not in NICKNAMES and (last in known or last in NICKNAMES):
        first, last = last, first
    if re.fullmatch(r"[a-z]", last):
        return "i", [last, first]
    return "k" if len(formal(first)) > 2 else "p", [first, last.replace("'", "")]


def block_keys(kind: str, parts: list[str]) -> list[str]:
    if kind in "pik":
        first, surname = parts
        letters = {g[0] for g in formal(first)} if kind != "i" else {first[0]}
        codes = {f"c{phonetic(surname)}", f"h{phonetic(surname[:5])}", f"t{phonetic(surname[-5:])}"}
        keys = [f"{c}|{x}" for c in codes for x in letters]
        return keys + [f"s{surname}"] if kind != "i" else keys
    if kind == "o":
        codes = [phonetic(w) for w in parts]
        return [f"o1{'-'.join(sorted(codes))}", f"o2{parts[0]}|{len(parts)}", f"o3{'-'.join(codes[-2:])}|{len(parts)}", f"o4{'-'.join(codes[1:3])}|{len(parts)}"]
    return []


def alike(kind: str, a: list[str], b: list[str], known: frozenset[str]) -> bool:
    if kind in "pk":
        return close(a[1], b[1]) and same_given(a[0], b[0], known)
    if kind == "o" and len(a) == len(b):
        return all(x == y or short_for(x, y) or (len(x) > 3 and close(x, y)) for x, y in zip(a, b)) and sum(x == y for x, y in zip(a, b)) >= len(a) - 2
    return False


def fits_initials(initials: list[str], full: list[str]) -> bool:
    """Whether a form with initials can stand for a full name."""
    letters, given = initials[0], full[0]
    parts = given.split("-")
    if len(letters) > 1 and (len(parts) < len(letters) or any(p[:1] != x for p, x in zip(parts, letters))):
        return False
    return close(initials[1], full[1]) and any(g[0] == letters[0] for g in formal(given))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        split = [plain(n).split(" ") for n in batch.column("name").to_pylist() if n]
        split = [w for w in split if len(w) == 2 and re.fullmatch("[a-z][a-z-]+", w[0])]
        yield pa.RecordBatch.from_arrays([pa.array([w[0] for w in split], pa.string()), pa.array([w[1] for w in split], pa.string())], ["g", "s"])


def given_names(strings: DataFrame) -> frozenset[str]:
    """Tokens that stand first before many different surnames; at most one in ``MIN_SURNAMES`` strings, in fact a few thousand."""
    counted = strings.mapInArrow(_pairs, "g string, s string").groupBy("g").agg(F.count_distinct("s").alias("n")).where(F.col("n") >= MIN_SURNAMES)
    top = counted.orderBy(F.desc("n")).limit(20).agg(F.min("n")).first()[0] or 0
    least = max(MIN_SURNAMES, KNOWN_SHARE * top)
    return frozenset(r["g"] for r in counted.where(F.col("n") >= least).orderBy(F.desc("n"), "g").limit(20_000).collect())


def _read(known: frozenset[str]):
    kinds = pa.schema([("name", pa.string()), ("kind", pa.string()), ("node", pa.string()), ("keys", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for name in batch.column("name").to_pylist():
                read = read_name(name, known)
                if read and all(read[1]):
                    kind, parts = read
                    for column, value in zip(out, (name, kind, f"{kind}|" + "|".join(parts), block_keys(kind, parts))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, kinds)], schema=kinds)

    return run


def _compare(known: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                (kind, *x), (other, *y) = a.split("|"), b.split("|")
                if kind == other:
                    keep.append(alike(kind, x, y, known))
                else:
                    keep.append(other == "p" and (fits_initials(x, y) if kind == "i" else kind == "k" and alike("p", x, y, known)))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def name_clusters(strings: DataFrame) -> DataFrame:
    """(name, cluster) of the distinct strings ``name`` that name somebody."""
    known = given_names(strings)
    read = cut_lineage(strings.select("name").mapInArrow(_read(known), "name string, kind string, node string, keys array<string>"))
    nodes = read.select("node", "kind", "keys").dropDuplicates(["node"])
    keyed = nodes.select("node", "kind", F.explode("keys").alias("key"))
    full = keyed.where("kind in ('p', 'k', 'o')")
    met = full.select(F.col("node").alias("a"), "kind", "key").join(full.select(F.col("node").alias("b"), "kind", "key"), ["kind", "key"]).where("a < b").select("a", "b").distinct()
    edges = met.mapInArrow(_compare(known), "a string, b string")
    joined = connected_components(cut_lineage(edges))
    clusters = nodes.select("node", "kind").join(joined, "node", "left").select("node", "kind", F.coalesce("comp", "node").alias("cluster"))
    clusters = cut_lineage(clusters)

    loose = keyed.where("kind in ('i', 'k')").select(F.col("node").alias("a"), "key").join(keyed.where("kind = 'p'").select(F.col("node").alias("b"), "key"), "key").select("a", "b").distinct()
    own = clusters.select(F.col("node").alias("a"), F.col("cluster").alias("loose"))
    fits = loose.mapInArrow(_compare(known), "a string, b string").join(clusters.select(F.col("node").alias("b"), "cluster"), "b").join(own, "a").select("loose", "cluster")
    tokens = F.split(F.col("node"), "\\|")
    short = F.concat(F.lit("a|"), F.array_join(F.transform(F.slice(tokens, 2, 20), lambda w: F.substring(w, 1, 1)), ""))
    acronyms = clusters.where("kind = 'o'").select(short.alias("loose"), "cluster").join(clusters.where("kind = 'a'").select(F.col("node").alias("loose")), "loose")
    one = fits.unionByName(acronyms).groupBy("loose").agg(F.count_distinct("cluster").alias("n"), F.min("cluster").alias("own")).where("n = 1").select(F.col("loose").alias("cluster"), "own")
    final = clusters.join(one, "cluster", "left").select("node", F.coalesce("own", "cluster").alias("cluster"))
    return read.where("kind <> 'x'").select("name", "node").join(final, "node").select("name", "cluster")


def distinct_names(articles: DataFrame, fields: tuple[str, ...] = ("people", "sources", "authors")) -> DataFrame:
    """(name): every string of the array columns once."""
    each = [articles.select(F.explode(f).alias("name")) for f in fields]
    union = each[0]
    for more in each[1:]:
        union = union.unionByName(more)
    return union.where("name is not null and name <> ''").distinct()


def found(articles: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a < name_b: strings that mean the same person or organisation."""
    clusters = cut_lineage(name_clusters(cut_lineage(distinct_names(articles))))
    other = clusters.select(F.col("name").alias("name_b"), "cluster")
    return clusters.withColumnRenamed("name", "name_a").join(other, "cluster").where("name_a < name_b").select("name_a", "name_b")

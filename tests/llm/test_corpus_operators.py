import itertools
import random
from collections import Counter

import pytest

from newsweft.llm import leakage, names, near_duplicates, toxicity
from newsweft.llm.components import connected_components

WORDS = [f"{a}{b}" for a in "bdfgklmnprstvz" for b in ("ado", "eru", "ilo", "opa", "uti", "aken", "iros", "ulem")]


def story(rng, n=80):
    return [rng.choice(WORDS) for _ in range(n)]


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    texts = {}
    for k in range(40):
        base = story(rng, rng.randint(40, 120))
        texts[f"s{k:02d}"] = base
        if k % 3 == 0:
            edited = [w if rng.random() > 0.05 else rng.choice(WORDS) for w in base]
            half = len(edited) // 2
            texts[f"t{k:02d}"] = edited[half:] + edited[:half]
        if k % 5 == 0:
            texts[f"u{k:02d}"] = list(base)
    rows = [(i, " ".join(w) + ".\nAdvertisement\n" + "Print this article", "clash", 1) for i, w in texts.items()]
    rows += [rows[0], ("null", None, "", 0), ("empty", "", "", 0), ("page", "Advertisement\nVideo", "", 0), ("page2", "Advertisement\nVideo", "", 0), ("long", " ".join(texts["s00"]) * 400, "", 0), ("zh", "市议会近日收到了两百多份意见书。", "", 0), ("zh2", "市议会近日收到了两百多份意见书。", "", 0)]
    a = spark.createDataFrame(rows, "_id string, body string, cls string, n int")
    got = {tuple(r) for r in near_duplicates.found(a).collect()}
    want = set()
    for x, y in itertools.combinations(sorted(texts), 2):
        cx, cy = Counter(texts[x]), Counter(texts[y])
        if sum((cx & cy).values()) >= 0.8 * max(len(texts[x]), len(texts[y])) - 1e-9:
            want.add((x, y))
    assert got == want and len(want) > 15
    assert near_duplicates.found(a.where("false")).count() == 0
    classes = {r[0]: (r.class_id, r.links) for r in near_duplicates.near_duplicate_classes(a).collect()}
    assert set(classes) == set(texts)
    assert {i: n for i, (_, n) in classes.items()} == {i: sum(i in p for p in want) for i in texts}
    assert all(classes[x][0] == classes[y][0] for x, y in want)
    assert near_duplicates.near_duplicate_classes(a.where("false")).count() == 0


def test_near_duplicates_without_common_runs(spark):
    """Every fifth word replaced, or the order lost: no five words in a row survive, four fifths of the words do."""
    rng = random.Random(31)
    texts, want = {}, set()
    for k in range(30):
        base = [f"{w}{rng.choice(WORDS)}" for w in story(rng, rng.choice([5, 20, 100, 180]))]
        edited = [f"new{rng.choice(WORDS)}{k}" if i % 5 == 4 else w for i, w in enumerate(base)]
        texts |= {f"s{k:02d}": base, f"t{k:02d}": edited if k % 2 else rng.sample(edited, len(edited))}
        texts[f"u{k:02d}"] = [f"other{rng.choice(WORDS)}{k}" if i % 5 == 4 or i == 0 else w for i, w in enumerate(base)]
    for x, y in itertools.combinations(sorted(texts), 2):
        if sum((Counter(texts[x]) & Counter(texts[y])).values()) >= 0.8 * max(len(texts[x]), len(texts[y])) - 1e-9:
            want.add((x, y))
    a = spark.createDataFrame([(i, " ".join(w) + ".") for i, w in texts.items()], "_id string, body string")
    assert {tuple(r) for r in near_duplicates.found(a).collect()} == want and len(want) >= 30


def test_near_duplicates_of_an_id_with_two_bodies(spark):
    """An id counts once, with one of its bodies, and neither body stands for the words of the other, in whatever order the rows come."""
    rng = random.Random(8)
    bases = {k: rng.sample(WORDS, 60) for k in "ab"}
    rows = [("1", bases["a"]), ("1", bases["b"])] + [(f"{k}{n}", ["new"] * n + bases[k][n:]) for k in bases for n in (2, 3)]
    found = [{tuple(r) for r in near_duplicates.found(spark.createDataFrame([(i, " ".join(w) + ".") for i, w in order], "_id string, body string")).collect()} for order in (rows, rows[::-1])]
    own = {("1", "a2"), ("1", "a3")}, {("1", "b2"), ("1", "b3")}
    assert found[0] == found[1] and found[0] - own[0] - own[1] == {("a2", "a3"), ("b2", "b3")}
    assert any(found[0] >= x and not found[0] & y for x, y in (own, own[::-1]))


def test_trie_equals_pairwise():
    rng = random.Random(2)
    sets = [sorted(rng.sample(range(60), rng.randint(10, 40))) for _ in range(60)]
    sets += [sorted(set(s[:-2]) | {rng.randint(0, 60)}) for s in sets[:20]]
    trie = near_duplicates.Trie()
    for k, s in enumerate(sets):
        trie.add(s, k)
    for s in sets:
        want = {k for k, o in enumerate(sets) if len(set(s) & set(o)) >= 0.8 * max(len(s), len(o)) - 1e-9}
        assert set(trie.similar(s)) == want


def test_leakage_against_brute_force(spark):
    rng = random.Random(9)
    items = [story(rng, rng.choice([8, 13, 14, 30])) for _ in range(20)]
    docs = []
    for k in range(60):
        words = story(rng, rng.randint(5, 200))
        item = items[k % 20]
        run = rng.choice([0, 12, 13, 20])
        if run and len(item) >= run:
            at = rng.randint(0, len(item) - run)
            words[3:3] = item[at : at + run]
        docs.append(words)
    docs.append(story(rng, 9000) + items[3] + story(rng, 200))
    text = lambda w: ", ".join(w).upper().replace("A", "Ａ").replace("O", "О")
    d = spark.createDataFrame([(k, text(w), "clash") for k, w in enumerate(docs)] + [(900, None, ""), (901, "", ""), (0, text(docs[0]), "clash")], "doc_id long, text string, m string")
    q = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(99, None)], "item_id long, text string")
    has = lambda w, v: any(w[i : i + 13] == v[j : j + 13] for i in range(len(w) - 12) for j in range(len(v) - 12))
    want = {(i, j) for i, w in enumerate(docs) for j, v in enumerate(items) if has(w, v)}
    assert {tuple(r) for r in leakage.leaked_items(d, q).collect()} == want and want
    assert leakage.leaked_items(d.where("false"), q).count() == 0


GIVEN = ["Judith", "Edward", "Philippa", "Abigail", "Theodore", "Renée"]
SURNAMES = ["Nalibezojand", "Hofanozedra", "Kagemibrodre", "Vakizobrodrith"]


def test_names(spark):
    entities = [
        ["Judith Nalibezojand", "Judy Nalibezojand", "By Judith Nalibezojand", "Nalibezojand, Judith", "NALIBEZOJAND JUDITH", "J. Nalibezojand", "Judith  B. Nalibezojand", "Judith Nalibezojand’s", "Judith Nalibezojnad", "Dr. Judith Nalibezojand", "Judith Nalibezojand, Staff Reporter", "Ｊudith Nalibezojand"],
        ["Edward Nalibezojand", "Edward \"Ted\" Nalibezojand"],
        ["Stonewick Lakeside Skating Corporation", "The Stonewick Lakeside Skating Corporation", "Stonewick Lake. Skating Corporation", "Skating Corporation of Stonewick Lakeside", "Lakeside Skating Corporation (Stonewick)", "Stonewick Lakeside Skating Corporation, Inc.", "SLSC", "S.L.S.C.", "Stonewick Lakeside Skating Corp."],
        ["Stonewick Coastal Police Foundation", "Stonewick Coastal Police Fdn."],
    ]
    people = [[f"{g} {s}"] for g in GIVEN for s in SURNAMES if f"{g} {s}" not in ("Judith Nalibezojand", "Edward Nalibezojand")]
    people.append(["Ted Nalibezojand"])  # Edward or Theodore: stays alone
    everyone = [x for e in entities + people for x in e]
    rows = [(everyone[::2], everyone[1::2], ["Staff", "", None, "Newsroom"], "clash"), (None, [], None, None), (everyone, None, everyone, "clash")]
    a = spark.createDataFrame(rows, "people array<string>, sources array<string>, authors array<string>, name string")
    want = {tuple(sorted(p)) for e in entities for p in itertools.combinations(e, 2)}
    got = {tuple(r) for r in names.found(a).collect()}
    assert got == want
    assert names.found(a.where("false")).count() == 0


def test_name_measures():
    assert names.edits("kebotude", "keobtude", 2) == 1 and names.edits("abc", "xyz", 2) == 3
    assert round(names.jaro_winkler("martha", "marhta"), 4) == 0.9611
    assert names.phonetic("bobby") == names.phonetic("popy")


def test_components(spark):
    chain = [(f"n{k:03d}", f"n{k + 1:03d}") for k in range(60)] + [("x", "y"), ("y", "x"), ("z", "z")]
    got = {r.node: r.comp for r in connected_components(spark.createDataFrame(chain, "a string, b string")).collect()}
    assert {got[f"n{k:03d}"] for k in range(61)} == {"n000"} and got["x"] == got["y"] == "x"


def test_components_of_long_paths(spark):
    """Paths that are walked in any order, and one whose two least nodes are its ends."""
    rng = random.Random(6)
    nodes = list(range(200))
    rng.shuffle(nodes)
    far = [0, *range(2, 300), 1]
    edges = list(zip(nodes, nodes[1:])) + [(1000 + x, 1000 + y) for x, y in zip(far, far[1:])]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {k: 0 for k in nodes} | {1000 + k: 1000 for k in far}


def test_kneser_ney_sums_to_one():
    """Brute force: every context's probabilities add up to one, and all n-grams count as the formula says."""
    import numpy as np

    rng = np.random.default_rng(1)
    sentences = [rng.integers(1, 7, size=rng.integers(1, 9)) for _ in range(40)]
    base = np.array([0.0, 1, 2, 3, 4, 5, 6])
    model = toxicity.KneserNey(toxicity._grams(sentences), base / base.sum())
    every = np.arange(7)
    for u, v in itertools.product(range(7), range(7)):
        p = model.probability(np.full(7, u), np.full(7, v), every)
        assert abs(p.sum() - 1) < 1e-9 and (p >= 0).all()
    rows = [tuple([0, 0, *s][k : k + 3]) for s in sentences for k in range(len(s))]
    c3 = Counter(rows)
    c2 = Counter((v, w) for _, v, w in c3)
    c1 = Counter(w for _, w in c2)
    d = lambda n: (0, 1.0, 0.9, 0.75)[min(n, 3)]
    for u, v, w in list(c3)[:50]:
        p = (c1[w] - d(c1[w]) + sum(map(d, c1.values())) * base[w] / base.sum()) / sum(c1.values())
        two = {x: n for (y, x), n in c2.items() if y == v}
        p = (two[w] - d(two[w]) + sum(map(d, two.values())) * p) / sum(two.values())
        three = {x: n for (y, z, x), n in c3.items() if (y, z) == (u, v)}
        p = (three[w] - d(three[w]) + sum(map(d, three.values())) * p) / sum(three.values())
        assert abs(p - model.probability(np.array([u]), np.array([v]), np.array([w]))[0]) < 1e-9


def test_toxicity_held_out(spark):
    rng = random.Random(4)
    nice = lambda: f"The {rng.choice(WORDS)} in {rng.choice(WORDS)} was {rng.choice(['sold', 'closed', 'painted'])} on {rng.choice(['Monday', 'Friday'])}."
    insults = ["moron", "idiot", "parasite", "clown"]
    nasty = lambda: rng.choice(["Shut up, you {} {}.", "Only {} {} would write this."]).format(rng.choice(["stupid", "filthy"]), rng.choice(insults))
    docs, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        parts = [nice() for _ in range(rng.randint(0 if bad else 1, 4))]
        if bad:
            parts.insert(rng.randint(0, len(parts)), nasty().replace("i", "1") if k % 8 == 0 and k > 300 else nasty())
        docs.append((k, " ".join(parts), "a" if k % 2 else None, "clash"))
        if k < 300:
            labels += [(k, "r1", int(bad)), (k, "r2", int(bad) if rng.random() > 0.05 else 1 - int(bad)), (k, "r3", None)]
    docs += [(900, None, None, ""), (901, "", None, ""), (902, "  ", None, ""), docs[0]]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, score string")
    m = spark.createDataFrame(labels, "doc_id long, rater string, label int")
    got = {r.doc_id for r in toxicity.found(d, m).collect()}
    want = {k for k in range(400) if k % 4 == 0}
    held = {k for k in got if k >= 300}
    assert len(held & want) >= 0.9 * 25 and len(held - want) <= 1
    rates = {r.source: (r.documents, r.flagged) for r in toxicity.source_rates(d, m).collect()}
    assert sum(n for n, _ in rates.values()) == 403 and None in rates
    assert toxicity.found(d, m.where("false")).count() == 0
    unscored = toxicity.source_rates(d, m.where("false")).collect()
    assert {r.source for r in unscored} == set(rates) and all(r.rate is None and r.reason for r in unscored)
    few = m.where("doc_id < 24")  # six toxic documents: the same rule, still something found
    assert len({r.doc_id for r in toxicity.found(d, few).collect()} & want) >= 40
    assert toxicity.score_documents(d.where("false"), m).count() == 0


@pytest.mark.parametrize("text,want", [("Y0U M0R0N", ["you", "moron"]), ("s c u m b a g", ["scumbag"]), ("i***t", ["<masked>"]), ("assssshole", ["ashole"]), ("p‐a-t‑h-e‐t-i‐c", ["pathetic"]), ("", [])])
def test_spelling_tricks(text, want):
    assert toxicity.tokens(text) == want

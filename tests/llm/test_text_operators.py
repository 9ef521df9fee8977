"""Small tables with every awkward case: nulls, empties, repeats, long texts, clashing extra columns."""

import random

import pytest
from pyspark.sql import functions as F

from newsweft.llm import boilerplate, lookalike, repeated_lines, sentences, tokenize

ARTICLE = "_id string, outlet string, body string, people array<string>, keys string, line_no string"


def articles(spark, rows):
    return spark.createDataFrame([(*r, None, "clash", "clash") if len(r) == 3 else (*r, "clash", "clash") for r in rows], ARTICLE)


def pairs(text, openings=frozenset()):
    return [text[a:b] for a, b in zip(*sentences.split_body(text, openings))]


@pytest.mark.parametrize(
    "text,want",
    [
        ("", []),
        ("  \n\t\n", []),
        ("Menu | News\nTwo words", ["Menu | News", "Two words"]),
        ("Dr. Lee met Mr. Roy at 5 p.m. Thursday. They left.", ["Dr. Lee met Mr. Roy at 5 p.m. Thursday.", "They left."]),
        ("It shut at 3 a.m. A crowd left. Prices fell 3.5 per cent in the U.S. market.", ["It shut at 3 a.m.", "A crowd left.", "Prices fell 3.5 per cent in the U.S. market."]),
        ('"Why go? Nobody will," Ann Lee said. "Yes," he said.', ['"Why go? Nobody will," Ann Lee said.', '"Yes," he said.']),
        ("It ended in May.A report came out.", ["It ended in May.", "A report came out."]),
        ("It grew... and people noticed. Fine!", ["It grew... and people noticed.", "Fine!"]),
        ("« Mon parc a été fermé. C’est assez », dit M. Roy. Voici l’art. 8 du texte.", ["« Mon parc a été fermé. C’est assez », dit M. Roy.", "Voici l’art. 8 du texte."]),
        ("议会说：“我们知道。谢谢。”市民走了！「好」，他说。", ["议会说：“我们知道。谢谢。”", "市民走了！", "「好」，他说。"]),
        ("「中止した。本当ですか？」と店主は尋ねた。終わった。", ["「中止した。本当ですか？」と店主は尋ねた。", "終わった。"]),
        ("परिषद ने डॉ. की बात टाली। क्यों? \"अब है?\" लोग ने पूछा।", ["परिषद ने डॉ. की बात टाली।", "क्यों?", "\"अब है?\" लोग ने पूछा।"]),
        ("• In brief: The bridge shut. It rained.", ["• In brief: The bridge shut.", "It rained."]),
        ("AT 3:15 A.M. A JOINT ALARM RANG. NO. 9 CLOSED.", ["AT 3:15 A.M. A JOINT ALARM RANG.", "NO. 9 CLOSED."]),
    ],
)
def test_sentences(text, want):
    assert pairs(text) == want


def test_sentences_without_marks():
    openings = frozenset(["ชาวบ้"])
    assert pairs("ชาวบ้านด้วยงบ 3.5 ล้านบาท ชาวบ้านเปิด", openings) == ["ชาวบ้านด้วยงบ 3.5 ล้านบาท", "ชาวบ้านเปิด"]


def test_sentences_cover_the_text():
    """Brute force: spans are in order, trimmed, within lines, and hold every visible character once."""
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("aB. !?“”\"«» \n0.5Dr…。」「") for _ in range(rng.randint(0, 60)))
        starts, ends = sentences.split_body(text)
        seen = [k for a, b in zip(starts, ends) for k in range(a, b)]
        assert len(seen) == len(set(seen)) and seen == sorted(seen)
        assert all(text[k].isspace() for k in set(range(len(text))) - set(seen))
        assert all("\n" not in text[a:b] and text[a:b] == text[a:b].strip() for a, b in zip(starts, ends))


def test_sentence_table(spark):
    rows = [("a", "x", "One. Two."), ("a", "x", "One. Two."), ("b", None, None), ("c", "x", ""), ("d", "x", "word. " * 20000), (None, "x", "No id.")]
    got = sentences.found(articles(spark, rows))
    assert got.where("_id = 'a'").orderBy("sent_start").collect() == [("a", 0, 4), ("a", 5, 9)]
    assert got.where("_id in ('b', 'c')").count() == 0 and got.where("_id is null").count() == 0
    assert got.columns == ["_id", "sent_start", "sent_end"]
    assert sentences.found(articles(spark, [])).count() == 0


def test_lookalikes():
    r = lookalike.Rewriter()
    strange = {"ｏｎｃｅ": "once", "été": "été", "ﬂoor": "floor", "bla​med": "blamed", "on　a b": "on a b", "Anne‑Sophie": "Anne-Sophie", "Тhаt": "That", "１２": "12", "Raуmond": "Raymond", "اﱂقال": "المقال"}
    for x, want in strange.items():
        assert r.rewrite(x) == want and r.rewrite(want) == want
    for x in ("The Σωκ society", "Ветер над рекой", "m²", "“curly” ’tis", "（见第3页）？", "मंज़ूर", "น้ำ", "œuvre", "…", "a–b"):
        assert r.rewrite(x) == x
    assert lookalike.fold_text("ＢＹ Тhе Ｓtaff") == "by the staff"


def test_more_lookalikes():
    r = lookalike.Rewriter()
    for x, want in {"𝐇𝐞𝐥𝐥𝐨": "Hello", "ｶﾞｽ": "ガス", "한국": "한국", "ᎳEST": "WEST", "ϲat": "cat", "ℎe": "he"}.items():
        assert r.rewrite(x) == want and r.rewrite(want) == want
    for x in ("ᏣᎳᎩ", "① ⓐ ™", "ガス", "x² H₂O"):
        assert r.rewrite(x) == x


def test_suspects_are_ranges():
    """Characters beyond U+FFFF are tried one by one on every character of a text, so they have to be few ranges; what changes is found all the same."""
    r = lookalike.Rewriter()
    beyond = sum(ord(c) > 0xFFFF for c in r.suspect.pattern) + r.suspect.pattern.count("\\U0001")
    assert 0 < beyond < 100
    assert all(map(r.suspect.search, r.to)) and r.rewrite("𝟗 𝐀") == "9 A"
    assert not r.suspect.search("The “café” of São Tomé, 東京 한국 € ½ 🙂")


def test_frequency_chooses_representatives(spark):
    """The hyphen, or the form of an accented letter, that a corpus writes mostly becomes the one form; without counts it would not."""
    texts = spark.createDataFrame([("well‐known café " * 3000,), ("well-known café",)], "text string")
    counts = lookalike.corpus_counts(texts)
    assert lookalike.Rewriter(counts).rewrite("well-known") == "well‐known" and lookalike.Rewriter().rewrite("well‐known") == "well-known"
    apart = lookalike.corpus_counts(spark.createDataFrame([("cafe\u0301 " * 3000,)], "text string"))
    assert lookalike.Rewriter(apart).rewrite("café") == "cafe\u0301" and lookalike.Rewriter(counts).rewrite("cafe\u0301") == "café"


def test_lookalike_table(spark):
    rows = [("a", "x", "fine\nﬂoor\n\nok", ["Ann", None, "Аnn"]), ("a", "x", "fine\nﬂoor\n\nok", ["Ann", None, "Аnn"]), ("b", None, None, None), ("c", "x", "", [])]
    got = {tuple(r) for r in lookalike.found(articles(spark, rows)).collect()}
    assert got == {("a", "body", 2), ("a", "people", 3)}
    assert lookalike.found(articles(spark, [])).count() == 0
    one = lookalike.canonicalise(articles(spark, rows[:1]), "body").first()
    assert one.body == "fine\nfloor\n\nok"


def test_union_find_is_transitive():
    c = lookalike.Classes()
    c.union("a", "b")
    c.union("c", "d")
    c.union("b", "c")
    assert len({c.find(x) for x in "abcd"}) == 1


def test_repeated_lines(spark):
    rows = [(str(k), "x", f"Story {'abcdefghijklmnopqrstuvwxyz'[k]} tells\nSubscribe for ${k} today!\n\n--- 9") for k in range(12)]
    rows += [(str(k), "x", None) for k in range(12, 20)] + [("0", "x", rows[0][2]), ("n", None, rows[0][2]), ("z", "y", rows[0][2])]
    a = articles(spark, rows)
    got = {tuple(r) for r in repeated_lines.found(a).collect()}
    assert got == {(str(k), 2) for k in range(12)}
    left = {r._id: r.body for r in repeated_lines.remove_repeated_lines(a, "_id").collect()}
    assert left["3"] == "Story d tells\n\n--- 9" and left["n"] == rows[0][2]
    assert repeated_lines.found(articles(spark, [])).count() == 0


def test_summary_bounds():
    """A merged summary never counts too much, nor too little by more than its error."""
    rng = random.Random(1)
    s, true = repeated_lines.Summary(capacity=20), {}
    for _ in range(5000):
        keys = {min(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(3)}
        s.add(keys)
        for k in keys:
            true[k] = true.get(k, 0) + 1
    s.shrink()
    assert len(s.counts) <= 20
    assert all(true[k] - s.error <= s.counts[k] <= true[k] for k in true)


def test_boilerplate(spark):
    page = "Home | News | Sports\nBy Ann Lee\nThe bridge shut on Monday.\nWhat tenants want\n- 3 farmers and a barn\nRead next: Why it may rain\nUnique repeated line\n© 2020 The X Media Inc. All rights reserved.\n • Advertisement\nAnn urged brewers to subscribe to the newsletter or share it."
    rows = [(str(k), "x", page) for k in range(12)] + [("0", "x", page), ("e", "x", ""), ("n", None, None), ("o", "y", "Unique repeated line")]
    got = {}
    for r in boilerplate.found(articles(spark, rows)).collect():
        got.setdefault(r._id, set()).add(r.line_no)
    assert got["3"] >= {1, 2, 6, 8, 9}  # and the lines that stand on every page of the host
    assert "o" not in got and "e" not in got and "n" not in got
    one = {r._id: r.line_no for r in boilerplate.found(articles(spark, [("1", "x", page)])).groupBy("_id").agg(F.sort_array(F.collect_list("line_no")).alias("line_no")).collect()}
    assert one == {"1": [1, 2, 6, 8, 9]}
    story = boilerplate.main_text(articles(spark, [("1", "x", page)])).first().body
    assert story.split("\n")[0] == "The bridge shut on Monday."
    assert boilerplate.found(articles(spark, [])).count() == 0


WORDS = [f"{a}{b}" for a in "bdfgklmnprstvz" for b in ("ado", "eru", "ilo", "opa", "uti", "aken", "iros", "ulem")]


def test_style_tree_decides(spark):
    """Furniture that no pattern knows goes by its nodes in the tree; a story line that looks like a prompt stays; a template goes though each line is new."""
    rng = random.Random(8)
    some = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    rows = []
    for k in range(60):
        lines = [f"{some(9)}." for _ in range(4)] + [some(4), some(5)] + ["Zebra circle members dine free", f"Gazebo picks {some(4)}", f"Related: {some(5)}", f"{some(2)} is a {some(1)} and writes about {some(1)} every {['Monday', 'Friday'][k % 2]}."]
        if k == 7:
            lines.append(f"Listen to this story from the barge, {some(3)}")
        rows.append((f"{k:02d}", "x", "\n".join(lines)))
    got = {}
    for r in boilerplate.found(articles(spark, rows)).collect():
        got.setdefault(r._id, set()).add(r.line_no)
    assert all(got[i] == {7, 8, 9, 10} for i, _, _ in rows)
    reasons = {(r.reason, r.style): r.lines for r in boilerplate.cuts_by_level(articles(spark, rows)).collect()}
    assert reasons == {("content", "heading"): 60, ("opening", "heading"): 60, ("presentation", "teaser"): 60, ("presentation", "note"): 60}


def test_tokenizer_round_trip(spark):
    texts = ["Hello world's  end\n\n x", "", None, "   ", "日本語 ไทย 🙂", "<|endoftext|> a", "a" * 30000, "it's 1,234 　x \t\n", "é \x85  z"]
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate([*texts, texts[0]])], "doc_id long, text string, word string")
    docs = docs.unionByName(docs.where("doc_id = 0"))
    encoded = tokenize.encode_corpus(docs)
    got = {r.doc_id: r.ids for r in encoded.collect()}
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(tokenize.tokenizer_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    assert got == {k: t.encode(x or "", add_special_tokens=False).ids for k, x in enumerate([*texts, texts[0]])}
    assert got[1] == got[2] == []
    back = {r.doc_id: r.text for r in tokenize.decode_corpus(encoded).collect()}
    assert back == {k: x or "" for k, x in enumerate([*texts, texts[0]])}
    assert tokenize.encode_corpus(docs.where("false")).count() == 0

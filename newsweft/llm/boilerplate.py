"""Page furniture mixed with the story (problem 7).

A site style tree over text pages: the pages of one host are merged into one tree
host -> presentation node -> opening node -> content node. The pages are plain text, so a line's
presentation is what its mark-up would have said (navigation bar, byline, share prompt, teaser
label, notice, heading, sentence ...), read from separators, labels, cue words and end marks. A
content node is the line without digits, punctuation, case and look-alikes; an opening node the
first two words of a line without an end mark. Patterns only propose a line's node; what the
merged pages show decides whether a node stays:

* An opening or content node is as important as 1 - H, where H is the entropy of its occurrences
  over the m pages of its host, to the base m: a node on one page has H = 0, one on all pages H = 1.
  Branches are cut whose importance is at most that of a node that stands on ``MIN_SHARE`` of the host's pages (at least ``MIN_PAGES``).
* A presentation node is as important as the children that are left to it are diverse. Its children are the
  openings (first word, first two words) and the closings (last two words) of its lines, over the pages of
  all hosts. Importance is the entropy of the children over that of the most diverse node's, or over the logarithm
  of the node's lines, whichever is less; the least of the three counts. Stories open and close in ever new ways,
  templates don't. A node of fewer than ``MIN_LINES`` lines shows nothing and stays; only where
  there are hardly any pages at all does the pattern alone decide.
  Presentations less diverse than ``LEAST_DIVERSITY`` are cut with all that is below them.

A line stays if no node of its branch is cut.

Cases: null and empty bodies have no lines; blank lines are no lines; null hosts form one host;
repeated ids count once; very long bodies are handled whole; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsweft.llm.lookalike import fold_text
from newsweft.llm.repeated_lines import keys_of_folded
from newsweft.session import cut_lineage

MIN_SHARE, MIN_PAGES = 0.03, 10
#: Presentation nodes less diverse than this are removed; those of fewer lines than ``MIN_LINES`` show nothing.
LEAST_DIVERSITY, MIN_LINES = 0.75, 8
#: Rows up to which the removable nodes of the hosts are broadcast (8 bytes each); beyond, hosts are split by salt.
BROADCAST_NODES, SALTS = 2_000_000, 32

#: Names of sections as they stand in navigation bars.
SECTIONS = set(
    "home news opinion sports business arts life video podcasts weather travel puzzles obituaries classifieds "
    "accueil actualités opinions affaires culture météo voyage jeux nécrologie annonces "
    "首页 新闻 财经 视频 旅游 文化 体育 评论 天气 社论 ホーム ニュース 経済 文化 動画 社説 スポーツ 天気 "
    "विचार मुखपृष्ठ समाचार व्यापार खेल वीडियो मौसम اقتصاد الرئيسية رياضة رأي طقس أخبار ثقافة فيديو "
    "ความเห็น วัฒนธรรม วิดีโอ กีฬา อากาศ ข่าว เศรษฐกิจ หน้าแรก".split()
)
#: The presentation that a line's wording gives away, after folding, by language.
CUES = {
    "byline": [r"(?:by|par) (?:\S+ ){0,5}\S+$", r"la rédaction, .{1,60}$", r"本文由.{1,40}(?:提供|报道)$"],
    "credit": [r"photos? ?:", r"illustrations? ?(?::|of |de )", r"(?:with files|with reporting) (?:from|by) ", r"avec (?:la collaboration|des informations) d", r"(?:图片|写真|फोटो|صورة|ภาพ) ?[::]", r"this (?:article|story|report|piece) was (?:reported|written|produced) by "],
    "note": [r".{3,70} is an? .{2,50} and writes (?:about|for) ", r".{3,70} is an? (?:reporter|columnist|journalist|editor) (?:with|at|for) ", r".{3,70} est .{2,50} et (?:écrit|signe une chronique) ", r".{3,70} covers the .{2,40} beat ", r"(?:\S+ ){1,5}couvre (?:les? |la |l.)(?:\S+ ){0,4}\S+ à \S+\.$"],
    "correction": [r"(?:corrections?|clarification|rectificatif|précision|更正|訂正|सुधार|تصحيح|แก้ไข) ?:"],
    "copyright": [r"© ?\d", r"copyright ", r"版权所有", r"this material may not be (?:published|reproduced)", r"toute reproduction ", r"(?:all rights reserved|tous droits réservés)"],
    "cookies": [r"(?:we use|this site (?:uses|stores)|cookies help us|we and our \d+ partners|by continuing you accept) ?(?:.*cookies)?", r"(?:nous utilisons des|ce site emploie des|nos \d+ partenaires déposent des) témoins", r"les témoins (?:servent|nous aident|permettent)", r"(?:en poursuivant|en continuant), vous acceptez"],
    "legal": [r"terms of use\b", r"conditions d.utilisation\b", r"privacy policy\b", r"comments are moderated", r"les commentaires sont modérés"],
    "share": [r"(?:share|print|email|save) this (?:article|story|report|piece)\b", r"(?:partager|imprimer) (?:cet article|ce texte|cette nouvelle)", r"[\d.,  ]+ (?:shares?|partages?)$", r"follow .{1,60} on \w+ ?:", r"suivez .{1,60} ?: ?@", r"分享本文", r"この記事をシェア", r"यह लेख साझा करें", r"شارك هذا المقال", r"แชร์บทความนี้", r"listen to this (?:article|story|report|piece)\b", r"écouter ?\("],
    "subscribe": [r"subscribe today\b", r"sign up for .{1,60}(?:briefing|newsletter)", r"inscrivez-vous à l.infolettre", r"abonnez-vous (?:pour|à|dès)", r"订阅.{1,30}(?:电子报|通讯)", r".{1,30}のメール配信に登録", r".{1,40} की डाक सूची से जुड़ें", r"اشترك في نشرة", r"สมัครรับจดหมายข่าว"],
    "comments": [r"join the conversation\b", r"commenter ?\(", r"(?:评论|コメント|टिप्पणियाँ|تعليقات|ความคิดเห็น) ?\(\d", r"have your say in (?:poll|our)", r".{3,160}\(\d+ (?:comments?|commentaires?)\)$"],
    "advert": [r"(?:story|article) continues below", r"advertisements?$", r"publicité$", r"l.article se poursuit", r"(?:广告|広告|विज्ञापन|إعلان|โฆษณา)$"],
    "teaser": [r"(?:recommended for you|read next|most read|related|more from [^:]{1,40}|also in [^:]{1,40}|in brief|also today|read more) ?:", r"read more .{1,40}from ", r"»", r"(?:à lire(?: aussi)?|les plus lus|à découvrir|dans la même rubrique|en bref|aussi) ?:", r"(?:热门|推荐|精选|人気|おすすめ|注目|लोकप्रिय|الأكثر قراءة|الأكثر شعبية|ยอดนิยม|相关阅读|関連記事|यह भी पढ़ें|اقرأ أيضا|อ่านต่อ) ?:", r"tap here to see "],
    "status": [r"updated \d+ (?:minutes?|hours?) ago", r"mis à jour il y a ", r"report an error\b", r"une erreur à signaler"],
}
_CUE = re.compile("|".join(f"(?P<{name}>{'|'.join(parts)})" for name, parts in CUES.items()))
_SPLIT = re.compile(r"\s*[|·>/]\s+|\s{3,}")
_END = re.compile(r"[.!?…。！？।؟][\"”’»」』)\]]*$")
_BULLET = re.compile(r"^[•●▪◦‣*]\s*")
_SPACE = re.compile(r"\s+")
_LETTERS = re.compile(r"[^\W\d_]+")
#: The presentations of lines that no pattern proposes a node for.
UNMARKED = {"sentence", "heading"}


def presentation(line: str) -> str:
    """The presentation node of a folded line with some text."""
    bare = _BULLET.sub("", line.strip())
    parts = _SPLIT.split(bare)
    if len(parts) > 2 and len(bare) < 160 and not _END.search(bare) and all(0 < len(p.split()) <= 3 for p in parts):
        return "navigation"
    text = _SPACE.sub(" ", bare)
    if text in SECTIONS:
        return "navigation"
    if m := _CUE.match(text):
        if m.lastgroup == "byline" and _END.search(text):
            return "sentence"
        return m.lastgroup
    return "sentence" if _END.search(text) else "heading"


def page_nodes(body: str | None) -> list[tuple]:
    """Of each line with text: number, presentation, keys of its first word, first two and last two words, of its opening node (0 for none) and of its content node."""
    from xxhash import xxh3_64_intdigest, xxh32_intdigest

    if not body:
        return []
    folded = fold_text(body)
    keys, out = keys_of_folded(folded), []
    for n, line in enumerate(folded.split("\n"), 1):
        if not line or line.isspace():
            continue
        style, found = presentation(line), _LETTERS.findall(line)
        ends = [xxh32_intdigest(" ".join(w)) - (1 << 31) for w in (found[:1], found[:2], found[-2:])]
        first = line.split(None, 3) if style == "heading" else ()
        out.append((n, style, *ends, xxh3_64_intdigest(" ".join(first[:2])) - (1 << 63) if len(first) > 2 else 0, keys[n - 1]))
    return out


_LINE = pa.struct([("line_no", pa.int32()), ("style", pa.string()), ("first", pa.int32()), ("first2", pa.int32()), ("last2", pa.int32()), ("opening", pa.int64()), ("content", pa.int64())])


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in _LINE]
    for batch in batches:
        lines = pa.array([[dict(zip(names, x)) for x in page_nodes(b)] for b in batch.column("body").to_pylist()], pa.list_(_LINE))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("host"), lines], ["id", "host", "lines"])


def page_lines(rows: DataFrame, id_col: str = "_id", host_col: str = "outlet", text_col: str = "body") -> DataFrame:
    """(id, host, lines) of every page once."""
    pages = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.coalesce(F.col(host_col), F.lit("")).alias("host"), F.col(text_col).alias("body"))
    nodes = pages.mapInArrow(_nodes, "id string, host string, lines array<struct<line_no int, style string, first int, first2 int, last2 int, opening bigint, content bigint>>")
    return cut_lineage(nodes.groupBy("id").agg(F.min("host").alias("host"), F.first("lines").alias("lines")))


def presentation_importance(lines: DataFrame, pages: int) -> dict[str, float]:
    """The importance of every presentation node by the entropy of its children; ``lines``: a struct ``x`` for each line. A few rows for each node come to the driver."""
    slot = lambda name: F.struct(F.lit(name).alias("slot"), F.col(f"x.{name}").alias("key"))
    each = lines.select("x.style", F.explode(F.array(*map(slot, ("first", "first2", "last2")))).alias("c"))
    counts = each.groupBy("style", "c.slot", "c.key").agg(F.count("*").alias("k"))
    rows = counts.groupBy("style", "slot").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.log2("k")).alias("s")).collect()
    most, out = defaultdict(float), {}
    for r in rows:
        most[r["slot"]] = max(most[r["slot"]], math.log2(r["n"]) - r["s"] / r["n"])
    for r in rows:
        style, n = r["style"], r["n"]
        if n < MIN_LINES:
            out[style] = 0.0 if pages < MIN_LINES and style not in UNMARKED else 1.0
        else:
            out[style] = min(out.get(style, 1.0), (math.log2(n) - r["s"] / n) / max(min(math.log2(n), most[r["slot"]]), 1e-9))
    return out


def _entropy(pages: Column) -> Column:
    """Of a node that stands once on each of some pages, to the base of all pages m."""
    return F.log(pages.cast("double")) / F.log(F.greatest(F.col("m").cast("double"), F.lit(2.0)))


def style_tree(nodes: DataFrame) -> DataFrame:
    """(host, level, node, pages, m, importance) of the opening and content nodes that stand on ``MIN_PAGES`` pages."""
    of = lambda level: F.transform("lines", lambda x: F.struct(F.lit(level).alias("level"), x[level].alias("node")))
    support = nodes.select("host", F.explode(F.array_distinct(F.concat(of("content"), of("opening")))).alias("k")).where("k.node <> 0")
    support = support.groupBy("host", "k.level", "k.node").agg(F.count("*").alias("pages")).where(F.col("pages") >= MIN_PAGES)
    m = nodes.groupBy("host").agg(F.count("*").alias("m"))
    return support.join(m, "host").select("host", "level", "node", "pages", "m", (1 - _entropy(F.col("pages"))).alias("importance"))


def furniture_reasons(rows: DataFrame, id_col: str = "_id", host_col: str = "outlet", text_col: str = "body") -> DataFrame:
    """(id, lines array<struct<line_no, style, reason>>): the lines outside the story, and the level of the tree at which their branch is cut."""
    nodes = page_lines(rows, id_col, host_col, text_col)
    least = 1 - _entropy(F.greatest(F.lit(float(MIN_PAGES)), F.col("m") * MIN_SHARE))
    # a host's low nodes number at most twice its lines a page over MIN_SHARE (its lines over MIN_PAGES where it has few pages)
    low = cut_lineage(style_tree(nodes).where(F.col("importance") <= least + 1e-12).groupBy("host").agg(F.collect_set("node").alias("low")))
    if (low.agg(F.sum(F.size("low"))).first()[0] or 0) <= BROADCAST_NODES:
        joined = nodes.join(F.broadcast(low), "host", "left")
    else:
        salted = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = nodes.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    has = lambda key: F.coalesce(F.array_contains("low", key) & (key != 0), F.lit(False))
    cut = lambda x: has(x["content"]) | has(x["opening"])
    important = presentation_importance(joined.select(F.explode(F.filter("lines", lambda x: ~cut(x))).alias("x")), nodes.count())
    dull = [s for s, v in important.items() if v < LEAST_DIVERSITY]
    reason = lambda x: F.when(has(x["content"]), "content").when(has(x["opening"]), "opening").when(x["style"].isin(*dull, ""), "presentation")
    marked = F.filter(F.transform("lines", lambda x: F.struct(x["line_no"].alias("line_no"), x["style"].alias("style"), reason(x).alias("reason"))), lambda x: x["reason"].isNotNull())
    return joined.select(F.col("id").alias(id_col), marked.alias("lines")).where(F.size("lines") > 0)


def furniture_lines(rows: DataFrame, id_col: str = "_id", host_col: str = "outlet", text_col: str = "body") -> DataFrame:
    """(id, lines array<int>): the numbers of the lines outside the story, for pages that have any."""
    return furniture_reasons(rows, id_col, host_col, text_col).withColumn("lines", F.transform("lines", lambda x: x["line_no"]))


def main_text(rows: DataFrame, id_col: str = "_id", host_col: str = "outlet", text_col: str = "body") -> DataFrame:
    """``rows`` with only the story in the text column."""
    gone = furniture_lines(rows, id_col, host_col, text_col).withColumnRenamed("lines", "__gone")
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda x, k: ~F.coalesce(F.array_contains(F.col("__gone"), k + 1), F.lit(False)))
    return rows.join(gone, id_col, "left").withColumn(text_col, F.array_join(kept, "\n")).drop("__gone")


def found(articles: DataFrame) -> DataFrame:
    return furniture_lines(articles).select("_id", F.explode("lines").alias("line_no"))


def cuts_by_level(articles: DataFrame) -> DataFrame:
    """(reason, style, lines): how many lines each level of the tree removes."""
    return furniture_reasons(articles).select(F.explode("lines").alias("x")).groupBy("x.reason", "x.style").agg(F.count("*").alias("lines"))

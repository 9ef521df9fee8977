"""Abusive, hateful or sexual content (problem 10).

Two class-conditional language models of words, toxic and ordinary, with interpolated
Kneser-Ney smoothing of order 3; their lowest order is shared, so rare expressions back
off to the same counts and only what the classes do differently moves the score. A sentence's
score is its log-likelihood ratio over its length, a document's that of its worst sentence.

The models are fitted on a sample of at most ``MAX_LABELLED`` labelled documents, each by at
most its whole text. Labels speak of whole documents and raters err, so fitting alternates
between choosing the sentences that make labelled documents toxic and estimating the models.
One rule sets the threshold, however many labels there are. Every labelled document is scored by models
fitted without its fold; the threshold is halfway between the median scores of the two classes,
or the least score that parts the classes best (by F1) if that is higher, as it is where labels are few. The folds and the final model are fitted side by side as tasks; what
comes back is bounded by the sample. Spelling tricks (look-alikes, spaced or starred letters,
digits for letters, drawn-out letters) are undone before.

Every document is scored; counts and rates cover all documents.

Cases: null, empty and blank texts have no score and are not flagged; without labels of both
classes nothing is scored, and the rate of every source is null; repeated ids count once, with their largest score; a null source is
a source of its own; null labels are ignored; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsweft.llm.lookalike import fold_text

#: Modified Kneser-Ney discounts of counts 1, 2 and more: what one labelled document alone says counts as smoothing only.
DISCOUNTS = np.array([0.0, 1.0, 0.9, 0.75])
#: Bounds of one word's log-likelihood ratio, so that no single unknown word decides.
LOW, HIGH = -2.0, 8.0
#: Words that a sentence counts as at least.
SHORT = 4
MAX_LABELLED, FOLDS, ROUNDS = 20_000, 5, 4

_SPREAD = re.compile(r"(?<!\w)[^\W_](?:[ \-.·_*][^\W_]){3,}(?!\w)")
_TOKEN = re.compile(r"[^\W_](?:[\w*@$]*[\w@$])?")
_SENTENCE = re.compile(r"[.!?…。！？।؟\n]+(?=\s|$|[\"”»」’')]|(?<=[。！？।؟\n]))")
#: Digits and signs that stand for letters.
_LEET = str.maketrans("013457@$8", "oieastasb")
_RUN = re.compile(r"(.)\1+")


def _plain(word: str) -> str:
    if word.isdigit():
        return "#"
    if "*" in word:
        return "<masked>"
    return _RUN.sub(r"\1", word if word.isalpha() else word.translate(_LEET))


def tokens(text: str) -> list[str]:
    """Words in the form the models see: tricks undone, runs of a letter shortened, numbers as #."""
    text = _SPREAD.sub(lambda m: re.sub(r"[^\w]|_", "", m[0]), fold_text(text).replace("’", " ").replace("'", " "))
    return [_plain(w) for w in _TOKEN.findall(text)]


def passages(text: str | None) -> list[list[str]]:
    """The words of every sentence."""
    return [w for part in _SENTENCE.split(text or "") if (w := tokens(part))]


class KneserNey:
    """An interpolated Kneser-Ney model over words 0 ... size - 1 and the shared distribution ``base`` of single words."""

    def __init__(self, grams: np.ndarray, base: np.ndarray) -> None:
        size = self.size = len(base)
        keys, counts = np.unique((grams[0] * size + grams[1]) * size + grams[2], return_counts=True)
        pairs, spread = np.unique(keys % (size * size), return_counts=True)  # continuation counts
        single = np.bincount(pairs % size, minlength=size)
        own = lambda n: np.where(n > 0, n - DISCOUNTS[np.minimum(n, 3)], 0.0)
        saved = lambda n: DISCOUNTS[np.minimum(n, 3)]
        total = max(1, single.sum())
        self.one = (own(single) + saved(single).sum() * base) / total if len(keys) else base
        self.pairs, self.pair_own = pairs, own(spread)
        self.pair_total = np.bincount(pairs // size, weights=spread, minlength=size)
        self.pair_saved = np.bincount(pairs // size, weights=saved(spread), minlength=size)
        self.keys, self.own = keys, own(counts)
        self.heads, at = np.unique(keys // size, return_inverse=True)
        self.head_total = np.bincount(at, weights=counts, minlength=len(self.heads))
        self.head_saved = np.bincount(at, weights=saved(counts), minlength=len(self.heads))

    @staticmethod
    def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], 0.0)

    def probability(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """P(w | u v), backing off to P(w | v) and P(w)."""
        p = self.one[w]
        total = self.pair_total[v]
        p = np.where(total > 0, (self._look(self.pairs, self.pair_own, v * self.size + w) + self.pair_saved[v] * p) / np.maximum(total, 1), p)
        head = u * self.size + v
        total = self._look(self.heads, self.head_total, head)
        return np.where(total > 0, (self._look(self.keys, self.own, head * self.size + w) + self._look(self.heads, self.head_saved, head) * p) / np.maximum(total, 1), p)


def _grams(sentences: list[np.ndarray]) -> np.ndarray:
    """(u, v, w) of every word w after u v; 0 begins a sentence."""
    if not sentences:
        return np.zeros((3, 0), dtype=np.int64)
    row = np.concatenate([x for s in sentences for x in (np.zeros(2, dtype=np.int64), s)])
    sizes = np.array([len(s) for s in sentences])
    skip = np.zeros(len(row), dtype=bool)
    starts = np.cumsum(sizes + 2) - sizes - 2
    skip[starts] = skip[starts + 1] = True
    at = np.flatnonzero(~skip)
    return np.stack([row[at - 2], row[at - 1], row[at]])


class Model:
    """Both class models over the words that labelled documents hold more than once; 0 begins a sentence, 1 is any other word."""

    def __init__(self, words: dict[str, int], toxic: list[np.ndarray], ordinary: list[np.ndarray]) -> None:
        self.words = words
        size = len(words) + 2
        one, two = _grams(toxic), _grams(ordinary)
        spread = np.unique(np.concatenate([one[1] * size + one[2], two[1] * size + two[2]])) % size
        base = np.bincount(spread, minlength=size).astype(float)
        base[1] += 1
        base /= base.sum()
        self.toxic, self.ordinary = KneserNey(one, np.maximum(base, 1e-12)), KneserNey(two, np.maximum(base, 1e-12))

    def encode(self, words: list[str]) -> np.ndarray:
        return np.array([self.words.get(w, 1) for w in words], dtype=np.int64)

    def sums(self, sentences: list[np.ndarray]) -> np.ndarray:
        """The log-likelihood ratio of every sentence."""
        if not sentences:
            return np.zeros(0)
        u, v, w = _grams(sentences)
        steps = np.clip(np.log(self.toxic.probability(u, v, w)) - np.log(self.ordinary.probability(u, v, w)), LOW, HIGH)
        ends = np.cumsum([len(s) for s in sentences])
        return np.add.reduceat(steps, np.r_[0, ends[:-1]])

    def scores(self, docs: list[list[list[str]]]) -> list[float | None]:
        """Of every document: its worst sentence's ratio over its length; None for no words."""
        flat = [self.encode(s) for d in docs for s in d]
        each = self.sums(flat) / np.maximum([len(s) for s in flat], SHORT) if flat else np.zeros(0)
        out, at = [], 0
        for d in docs:
            out.append(float(each[at : at + len(d)].max()) if d else None)
            at += len(d)
        return out


def fit_models(docs: list[tuple[list[list[str]], float]]) -> Model | None:
    """Alternates between choosing the toxic sentences of labelled documents and estimating the models; None without both classes."""
    if not any(label > 0.5 for _, label in docs) or not any(label < 0.5 for _, label in docs):
        return None
    seen = Counter(w for d, _ in docs for s in d for w in s)
    words = {w: k for k, w in enumerate((w for w, n in sorted(seen.items()) if n > 1), 2)}
    sure = [label > 0.5 for _, label in docs]
    code = [[np.array([words.get(w, 1) for w in s], dtype=np.int64) for s in d] for d, _ in docs]
    flat, label = [s for d in code for s in d], np.array([label for d, (_, label) in zip(code, docs) for _ in d])
    ordinary = [s for d, (_, x) in zip(code, docs) if x < 0.5 for s in d]
    toxic = [s for d, x in zip(code, sure) if x and len(d) <= 2 for s in d] or [s for d, x in zip(code, sure) if x for s in d]
    for _ in range(ROUNDS):
        model = Model(words, toxic, ordinary)
        posterior = model.sums(flat) + math.log(max(1, len(toxic)) / max(1, len(ordinary)))
        bad = (posterior > 0) & (label >= 0.5)
        good = (posterior <= 0) & ~bad
        if not bad.any() or not good.any():
            return model
        toxic, ordinary = [flat[k] for k in np.flatnonzero(bad)], [flat[k] for k in np.flatnonzero(good)]
    return Model(words, toxic, ordinary)


def threshold(held: list[tuple[float, bool]]) -> float:
    """Halfway between the classes' medians, or the least of the scores that part them about best by F1 if that is higher."""
    toxic, ordinary = ([x for x, y in held if y == kind] for kind in (True, False))
    if not toxic or not ordinary:
        return 0.0
    ranked, hits, f1 = sorted(held, reverse=True), 0, []
    for n, (_, y) in enumerate(ranked, 1):
        hits += y
        f1.append(2 * hits / (n + len(toxic)))
    best = min(ranked[n][0] for n, f in enumerate(f1) if f >= max(f1) - 0.005)
    return max(best, float(np.median(toxic) + np.median(ordinary)) / 2)


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(fold, text, share): at most MAX_LABELLED labelled texts with the share of raters that call them toxic."""
    marks = labels.where("label is not null").groupBy("doc_id").agg(F.avg("label").alias("share"))
    texts = docs.select("doc_id", "text").where("text is not null").join(marks, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("share").alias("share"))
    return texts.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED).select(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold"), "text", "share")


def _fit(rows: pa.Table) -> pa.Table:
    """The sample without one fold: models, and the scores of that fold. ``FOLDS`` is no fold: all of the sample, and the models themselves."""
    left_out = rows.column("task")[0].as_py()
    docs = [(f, (p, s)) for f, t, s in zip(rows.column("fold").to_pylist(), rows.column("text").to_pylist(), rows.column("share").to_pylist()) if (p := passages(t))]
    model = fit_models([x for f, x in docs if f != left_out])
    held = [x for f, x in docs if f == left_out and x[1] != 0.5]
    scores = model.scores([d for d, _ in held]) if model and held else []
    kept = [pickle.dumps(model)] if left_out == FOLDS and model else [None]
    return pa.table({"scores": pa.array([scores], pa.list_(pa.float64())), "marks": pa.array([[s > 0.5 for _, s in held][: len(scores)]], pa.list_(pa.bool_())), "model": pa.array(kept, pa.binary())})


def fit(docs: DataFrame, labels: DataFrame) -> tuple[bytes, float] | None:
    """(model, threshold); None without labels of both classes."""
    sample = labelled_sample(docs, labels).withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(FOLDS))))
    rows = sample.groupBy("task").applyInArrow(_fit, "scores array<double>, marks array<boolean>, model binary").collect()
    model = next((bytes(r["model"]) for r in rows if r["model"] is not None), None)
    if model is None:
        return None
    return model, threshold([(x, y) for r in rows for x, y in zip(r["scores"], r["marks"])])


def _scores(fitted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(fitted.value)
        for batch in batches:
            out = model.scores([passages(t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(out, pa.float64())], ["doc_id", "source", "score"])

    return run


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, source, score, flagged) of every document."""
    fitted = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    if fitted is None:
        return rows.select("doc_id", "source", F.lit(None).cast("double").alias("score"), F.lit(None).cast("boolean").alias("flagged")).distinct()
    model, least = fitted
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the labelled sample
    scored = rows.mapInArrow(_scores(shared), "doc_id long, source string, score double")
    scored = scored.groupBy("doc_id").agg(F.min("source").alias("source"), F.max("score").alias("score"))
    return scored.withColumn("flagged", F.coalesce(F.col("score") > least, F.lit(False)))


def source_rates(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(source, documents, flagged, rate, reason): without models flagged and rate are null, and ``reason`` says why."""
    each = score_documents(docs, labels).groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("flagged").cast("long")).alias("flagged"))
    return each.withColumn("rate", F.round(F.col("flagged") / F.col("documents"), 6)).withColumn("reason", F.when(F.col("flagged").isNull(), "no labels of both classes"))


def found(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, labels).where("flagged").select("doc_id")

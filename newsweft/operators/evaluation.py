"""Metrics of predicted quotes, names and genders against gold annotations."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsweft.functions.text import clean_name

THRESHOLDS = (0.3, 0.8)


def eval_name(name: Column, language: str = "en") -> Column:
    return F.lower(clean_name(name)) if language == "en" else F.replace(F.lower(name), F.lit("’"), F.lit("'"))


def _share(a: tuple[int, int], b: tuple[int, int]) -> float:
    size = a[1] - a[0]
    return max(0, min(a[1], b[1]) - max(a[0], b[0])) / size if size > 0 else 0.0


_FIELDS = ("q_start", "q_end", "s_start", "s_end", "v_start", "v_end", "floating")


def _greedy(gold: list[dict], predicted: list[dict], threshold: float) -> tuple[int, int, int]:
    """(matched, speakers, verbs): each gold quote in order takes the free prediction of the largest overlap share."""
    free = sorted(predicted, key=lambda p: p["q_start"])
    matched = speakers = verbs = 0
    for q in sorted(gold, key=lambda q: q["q_start"]):
        best = max(((_share((q["q_start"], q["q_end"]), (p["q_start"], p["q_end"])), -k) for k, p in enumerate(free)), default=(0.0, 0))
        if best[0] <= threshold:
            continue
        p = free.pop(-best[1])
        matched += 1
        silent = q["s_start"] is None
        if silent:
            speakers += bool(p["floating"])
        elif p["s_start"] is not None:
            speakers += _share((q["s_start"], q["s_end"]), (p["s_start"], p["s_end"])) > 0
        verbs += (q["v_start"], q["v_end"]) == (p["v_start"], p["v_end"])
    return matched, speakers, verbs


def match_quotes(gold: DataFrame, predicted: DataFrame, threshold: float) -> DataFrame:
    """(doc, targets, predictions, matched, speakers, verbs): greedy one-to-one matches by best overlap share.

    Both inputs: doc, q_start, q_end, s_start, s_end, v_start, v_end, floating; quotes without a
    span are left out. The choice depends on earlier ones, so it is made per document, over the
    two arrays of its quotes, in Arrow batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(g or [], p or []) for g, p in zip(batch.column("g").to_pylist(), batch.column("p").to_pylist())]
            got = [(len(g), len(p), *_greedy(g, p, threshold)) for g, p in pairs]
            columns = [pa.array([r[k] for r in got], pa.int64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns], ["doc", "targets", "predictions", "matched", "speakers", "verbs"])

    grouped = lambda df, name: df.where("q_start is not null and q_end is not null").groupBy("doc").agg(F.collect_list(F.struct(*_FIELDS)).alias(name))
    both = grouped(gold, "g").join(grouped(predicted, "p"), "doc", "full")
    kind = gold.schema["doc"].dataType.simpleString()
    return both.mapInArrow(run, f"doc {kind}, targets long, predictions long, matched long, speakers long, verbs long")


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def quote_metrics(matches: DataFrame) -> DataFrame:
    """precision, recall, F1 and the accuracies of speakers and verbs among matched quotes."""
    s = matches.agg(*[F.sum(c).alias(c) for c in ("targets", "predictions", "matched", "speakers", "verbs")])
    p, r = ratio(F.col("matched"), F.col("predictions")), ratio(F.col("matched"), F.col("targets"))
    return s.select("*", p.alias("precision"), r.alias("recall"), F.try_divide(2 * p * r, p + r).alias("f1"), ratio(F.col("speakers"), F.col("matched")).alias("speaker_accuracy"), ratio(F.col("verbs"), F.col("matched")).alias("verb_accuracy"))


def overlap_counts(gold: DataFrame, predicted: DataFrame, least: int = 2) -> DataFrame:
    """(tp, fn, fp) of spans, many to many: any overlap of ``least`` characters within a document counts."""
    pairs = gold.select("doc", F.col("start").alias("a"), F.col("end").alias("b")).join(predicted.select("doc", F.col("start").alias("c"), F.col("end").alias("d")), "doc")
    hits = pairs.where(F.least("b", "d") - F.greatest("a", "c") >= least)
    tp = hits.agg(F.count("*").alias("tp"), F.lit(1).alias("k"))
    g = gold.agg(F.count("*").alias("g"), F.lit(1).alias("k"))
    p = predicted.agg(F.count("*").alias("p"), F.lit(1).alias("k"))
    return tp.join(g, "k").join(p, "k").select("tp", (F.col("g") - F.col("tp")).alias("fn"), (F.col("p") - F.col("tp")).alias("fp"))


def list_metrics(rows: DataFrame, gold: str, predicted: str, by: list[str] = ()) -> DataFrame:
    """tp, fp, fn over two array columns with precision, recall and F1 in per cent; null where undefined."""
    tp, fp, fn = F.size(F.array_intersect(gold, predicted)), F.size(F.array_except(predicted, gold)), F.size(F.array_except(gold, predicted))
    out = rows.groupBy(*by).agg(F.sum(tp).alias("tp"), F.sum(fp).alias("fp"), F.sum(fn).alias("fn"))
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")) * 100, ratio(F.col("tp"), F.col("tp") + F.col("fn")) * 100
    return out.withColumn("precision", F.round(p, 3)).withColumn("recall", F.round(r, 3)).withColumn("f1", F.round(F.try_divide(2 * p * r, p + r), 3))


def gender_ratio(rows: DataFrame, female: Column, male: Column, unknown: Column, by: list[str] = ()) -> DataFrame:
    """Shares of female, male and unknown, to three places."""
    out = rows.groupBy(*by).agg(F.sum(female).alias("f"), F.sum(male).alias("m"), F.sum(unknown).alias("u"))
    total = F.col("f") + F.col("m") + F.col("u")
    return out.select(*by, *[F.round(F.coalesce(F.try_divide(F.col(c), total), F.lit(0.0)), 3).alias(n) for c, n in (("f", "female"), ("m", "male"), ("u", "unknown"))])

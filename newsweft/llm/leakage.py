"""Evaluation texts leaking into training text (problem 9).

MinHash containment search over size-partitioned texts: every text is partitioned into windows
of exactly ``RUN`` words, so that "the document contains a run of the item" becomes "a window
of one equals a window of the other". Each window is sketched by the minimum hash of its
``SHINGLE``-word shingles; equal windows have equal minima, so no run is lost, and neighbouring
windows share minima, so a text keeps only some 2 / (RUN - SHINGLE + 2) of its words. Long
texts are first cut into overlapping parts of bounded size. Items and documents that share a
minimum are candidates; they are verified by exact containment of a whole run of words.

Letter case, punctuation, spacing and look-alike characters never matter. Items are a query
set against all documents; they are broadcast only below ``BROADCAST_ROWS`` sketch rows.

Cases: null, empty and short texts (fewer than ``RUN`` words) hold nothing; repeated ids and
texts are reported once per id; items without text are never found; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsweft.llm.lookalike import words

RUN, SHINGLE = 13, 5
#: Words of a part of a long text; parts overlap by RUN - 1 words.
PART = 4096
BROADCAST_ROWS = 500_000


def shingle_hashes(tokens: list[str], size: int = SHINGLE) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words."""
    from xxhash import xxh3_64_intdigest

    known: dict[str, int] = {}
    ids = np.fromiter((known[w] if w in known else known.setdefault(w, xxh3_64_intdigest(w)) for w in tokens), dtype=np.uint64, count=len(tokens))
    n = len(tokens) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            out = (out ^ ids[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def window_minima(tokens: list[str]) -> list[int]:
    """The distinct minimum shingle hashes of all windows of RUN words."""
    if len(tokens) < RUN:
        return []
    span = RUN - SHINGLE + 1
    found: set[int] = set()
    for at in range(0, len(tokens) - RUN + 1, PART - RUN + 1):
        hashes = shingle_hashes(tokens[at : at + PART])
        if len(hashes) >= span:
            found.update(np.lib.stride_tricks.sliding_window_view(hashes, span).min(axis=1).astype(np.int64).tolist())
    return list(found)


def shares_run(a: list[str], b: list[str], run: int = RUN) -> bool:
    """Whether both lists hold the same ``run`` words in a row."""
    if len(a) < run or len(b) < run:
        return False
    short, long = (a, b) if len(a) < len(b) else (b, a)
    runs = {tuple(short[k : k + run]) for k in range(len(short) - run + 1)}
    heads = {r[0] for r in runs}
    return any(long[k] in heads and tuple(long[k : k + run]) in runs for k in range(len(long) - run + 1))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        minima = pa.array([window_minima(words(t)) if t else [] for t in batch.column("text").to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("id"), minima], ["id", "minima"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [shares_run(words(a), words(b)) for a, b in zip(batch.column("text").to_pylist(), batch.column("item_text").to_pylist())]
        yield batch.select(["doc_id", "item_id"]).filter(pa.array(ok, pa.bool_()))


def leaked_items(docs: DataFrame, items: DataFrame, doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id): the document holds at least RUN words of the item in a row."""
    d = docs.select(F.col(doc_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    q = items.select(F.col(item_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    sketch = lambda df: df.mapInArrow(_sketch, "id long, minima array<bigint>").select("id", F.explode("minima").alias("m"))
    wanted = sketch(q).withColumnRenamed("id", "item_id").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    pairs = sketch(d).join(wanted, "m").select(F.col("id").alias("doc_id"), "item_id").distinct()
    texts = d.withColumnRenamed("id", "doc_id").join(pairs, "doc_id").join(q.select(F.col("id").alias("item_id"), F.col("text").alias("item_text")), "item_id")
    sure = texts.select("doc_id", "item_id", "text", "item_text").mapInArrow(_verify, "doc_id long, item_id long")
    return sure.distinct().select(F.col("doc_id").alias(doc_col), F.col("item_id").alias(item_col))

"""Lines repeated across one source's documents (problem 5).

Every document becomes the array of its lines' keys: 64-bit hashes of the folded line without
digits, punctuation and spacing (0 for lines without a letter). Each partition keeps, for each
source, a Misra-Gries summary of the keys (each key once a document); summaries merge by adding
counts and error bounds. A key whose count plus its source's error reaches the threshold is a
candidate, so no line over the threshold is lost. Candidates are counted exactly in a second
pass over distinct documents, and confirmed lines are removed by number.

``CAPACITY`` bounds a summary; if a source's error ever reaches its threshold (documents with
many more lines than ``CAPACITY`` allows for), all keys of that source are counted exactly.

Cases: null source -> left out; null or empty body -> no line, yet the document counts in its
source; repeated ids count once; blank lines and lines without letters are never repeated
lines; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsweft.llm.lookalike import fold_text
from newsweft.session import cut_lineage

#: A line is repeated from so many documents and so large a share of its source's documents.
MIN_DOCS, MIN_SHARE = 10, 0.03
#: Keys kept in one summary of one source.
CAPACITY = 8192
#: Keys of confirmed or candidate lines up to which they are broadcast; beyond, they are joined by shuffle.
BROADCAST_ROWS = 500_000

_DROP_ASCII = bytes(c for c in range(128) if not chr(c).isalpha() and chr(c) != "\n")
#: Marks that are part of letters in Arabic, Indic scripts and Thai are kept.
_DROP = re.compile("[^\\w\n\u0610-\u061a\u064b-\u065f\u0900-\u0963\u0966-\u0dff\u0e00-\u0eff]|[\\d_]")


def line_keys(body: str | None) -> list[int]:
    """A key for each line; 0 for lines without a letter."""
    return keys_of_folded(fold_text(body)) if body else []


def keys_of_folded(text: str) -> list[int]:
    from xxhash import xxh3_64_intdigest

    packed = text.encode().translate(None, _DROP_ASCII) if text.isascii() else _DROP.sub("", text).encode("utf-8", "surrogatepass")
    return [xxh3_64_intdigest(x) - (1 << 63) if x else 0 for x in packed.split(b"\n")]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = pa.array([line_keys(b) for b in batch.column("body").to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("source"), keys], ["id", "source", "keys"])


class Summary:
    """A mergeable Misra-Gries summary: every count is at most ``error`` below the true one."""

    def __init__(self, capacity: int = CAPACITY) -> None:
        self.capacity, self.counts, self.error = capacity, Counter(), 0

    def add(self, keys) -> None:
        self.counts.update(keys)
        if len(self.counts) > 2 * self.capacity:
            self.shrink()

    def shrink(self) -> None:
        if len(self.counts) > self.capacity:
            cut = sorted(self.counts.values(), reverse=True)[self.capacity]
            self.cut(cut)

    def cut(self, cut: int) -> None:
        if cut > 0:
            self.error += cut
            self.counts = Counter({k: n - cut for k, n in self.counts.items() if n > cut})


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Summary] = {}
    docs: Counter = Counter()
    for batch in batches:
        for source, keys in zip(batch.column("source").to_pylist(), batch.column("keys").to_pylist()):
            docs[source] += 1
            own = set(keys)
            own.discard(0)
            held.setdefault(source, Summary()).add(own)
    out = []
    for source, summary in held.items():
        summary.shrink()
        summary.cut(int(docs[source] * MIN_SHARE / 3))
        out += [(source, 0, 0, summary.error, docs[source])]
        out += [(source, k, n, 0, 0) for k, n in summary.counts.items()]
    kinds = pa.schema([("source", pa.string()), *((c, pa.int64()) for c in ("key", "n", "error", "docs"))])
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t.type) for k, t in enumerate(kinds)], schema=kinds)


def repeated_lines(rows: DataFrame, id_col: str = "_id", source_col: str = "outlet", text_col: str = "body") -> DataFrame:
    """(id, line_no) of every line repeated within its source."""
    texts = rows.where(F.col(source_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("body"))
    keyed = texts.mapInArrow(_keys, "id string, source string, keys array<bigint>")
    keyed = cut_lineage(keyed.groupBy("id").agg(F.min("source").alias("source"), F.first("keys").alias("keys")))

    merged = keyed.mapInArrow(_summaries, "source string, key long, n long, error long, docs long")
    merged = cut_lineage(merged.groupBy("source", "key").agg(F.sum("n").alias("n"), F.sum("error").alias("error"), F.sum("docs").alias("docs")))
    limits = merged.where("key = 0").select("source", "error", F.greatest(F.lit(float(MIN_DOCS)), F.col("docs") * MIN_SHARE - 1e-9).alias("least"))
    candidates = merged.where("key <> 0").join(limits.withColumnRenamed("error", "e"), "source").where("n + e >= least").select("source", "key", "least")
    candidates = cut_lineage(candidates)
    small = candidates.count() <= BROADCAST_ROWS

    lines = keyed.select("id", "source", F.posexplode("keys").alias("pos", "key")).where("key <> 0")
    unsure = limits.where("error >= least").select("source", "least")
    known = lines.join(F.broadcast(candidates) if small else candidates, ["source", "key"])
    if unsure.take(1):
        known = known.join(unsure, "source", "left_anti").unionByName(lines.join(unsure, "source"))
    counted = known.select("source", "key", "id", "least").distinct().groupBy("source", "key", "least").count()
    confirmed = counted.where("count >= least").select("source", "key")
    hits = known.join(F.broadcast(confirmed) if small else confirmed, ["source", "key"], "left_semi")
    return hits.select(F.col("id").alias(id_col), (F.col("pos") + 1).alias("line_no"))


def remove_repeated_lines(rows: DataFrame, id_col: str = "_id", source_col: str = "outlet", text_col: str = "body") -> DataFrame:
    """``rows`` with the repeated lines taken out of the text column."""
    gone = repeated_lines(rows, id_col, source_col, text_col).groupBy(id_col).agg(F.collect_set("line_no").alias("__gone"))
    joined = rows.join(gone, id_col, "left")
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda x, k: ~F.coalesce(F.array_contains(F.col("__gone"), k + 1), F.lit(False)))
    return joined.withColumn(text_col, F.array_join(kept, "\n")).drop("__gone")


def found(articles: DataFrame) -> DataFrame:
    return repeated_lines(articles)

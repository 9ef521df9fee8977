"""Encoding a corpus with a public byte-level BPE tokenizer (problem 8).

Global distinct-word shuffle: every text is cut into pre-tokens (JVM regular expression),
the distinct pre-tokens of the whole corpus are encoded once each, and the ids are joined
back by pre-token and put together by position.

A pre-token such as " the" makes up several per cent of all rows, so the join back is split:
pre-tokens that occur at least once per ``HOT_SHARE`` of all rows number at most
``1 / HOT_SHARE`` by counting, which bounds the table that is broadcast; all others are
joined by shuffle, where none can be hot.

Cases: null, empty text -> empty list of ids; blank text is ordinary text; repeated rows
(same id twice) keep one row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from newsweft.session import cut_lineage

#: Share of all pre-token rows from which one pre-token counts as hot.
HOT_SHARE = 1 / 2000

#: Bits of an id (vocabularies of up to 131,072) and of its place in its pre-token; 26 bits are left for the pre-token.
ID_BITS, PLACE_BITS = 17, 20

#: The pre-token pattern of the byte-level vocabulary, with Unicode white space written out for Java.
_SPACE = "\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
PRETOKEN = (
    "'(?:[sdmt]|ll|ve|re)"
    "| ?\\p{L}+"
    "| ?\\p{N}+"
    f"| ?[^{_SPACE}\\p{{L}}\\p{{N}}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])"
    f"|[{_SPACE}]+"
)


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}


def _encode_words(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        coder = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=read_ranks(path), special_tokens={})
        for batch in batches:
            ids = pa.array([coder.encode_ordinary(w) for w in batch.column("word").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), ids], ["word", "n", "ids"])

    return run


def pretokens(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per pre-token: (doc, pos, word)."""
    words = F.expr(f"regexp_extract_all(`{text_col}`, r'({PRETOKEN.replace(chr(39), chr(92) + 'x27')})', 1)")
    return docs.select(F.col(id_col).alias("doc"), F.posexplode(words).alias("pos", "word"))


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(``id_col``, ids array<int>): the ids of every text, without special tokens."""
    path = path or tokenizer_path()
    if max(read_ranks(path).values()) >> ID_BITS:
        raise ValueError("the vocabulary needs more than ID_BITS bits")
    docs = docs.select(id_col, text_col).dropDuplicates([id_col])
    rows = pretokens(docs, id_col, text_col)
    counted = rows.groupBy("word").agg(F.count("*").alias("n"))
    words = cut_lineage(counted.mapInArrow(_encode_words(path), "word string, n long, ids array<int>"))
    total = words.agg(F.sum("n")).first()[0] or 0
    hot = words.where(F.col("n") >= F.lit(max(total * HOT_SHARE, 1000.0))).select("word", F.col("ids").alias("hot_ids"))
    rest = words.where(F.col("n") < F.lit(max(total * HOT_SHARE, 1000.0))).select("word", "ids")
    tagged = rows.join(F.broadcast(hot), "word", "left")
    known = tagged.where("hot_ids is not null").select("doc", "pos", F.col("hot_ids").alias("ids"))
    looked_up = tagged.where("hot_ids is null").select("doc", "pos", "word").join(rest, "word").select("doc", "pos", "ids")
    # one long for each id, in the order of the text: position of the pre-token, place in it, id
    one = known.unionByName(looked_up).select("doc", "pos", F.posexplode("ids").alias("k", "id"))
    packed = one.select("doc", (F.shiftleft(F.col("pos").cast("long"), PLACE_BITS + ID_BITS) + F.shiftleft(F.col("k").cast("long"), ID_BITS) + F.col("id")).alias("x"))
    pieces = packed.groupBy("doc").agg(F.sort_array(F.collect_list("x")).alias("p"))
    ids = pieces.select(F.col("doc").alias(id_col), F.transform("p", lambda x: x.bitwiseAND(F.lit((1 << ID_BITS) - 1)).cast("int")).alias("ids"))
    none = F.array().cast(T.ArrayType(T.IntegerType()))
    return docs.select(id_col).join(ids, id_col, "left").select(id_col, F.coalesce("ids", none).alias("ids"))


def decode_corpus(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(``id_col``, text): joins the ids with the token-byte table (bounded by the vocabulary) and decodes."""
    spark = encoded.sparkSession
    ranks = read_ranks(path or tokenizer_path())
    table = spark.createDataFrame([(i, bytearray(b)) for b, i in ranks.items()], "id int, bytes binary")
    rows = encoded.select(F.col(id_col).alias("doc"), F.posexplode(ids_col).alias("pos", "id"))
    parts = rows.join(F.broadcast(table), "id").groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("pos", F.hex("bytes").alias("h")))).alias("p"))
    text = parts.select(F.col("doc").alias(id_col), F.decode(F.unhex(F.array_join(F.transform("p", lambda x: x["h"]), "")), "UTF-8").alias("text"))
    return encoded.select(id_col).join(text, id_col, "left").select(id_col, F.coalesce("text", F.lit("")).alias("text"))

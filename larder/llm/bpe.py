"""Byte-level BPE: encoding by overlapping chunks, decoding by joining bytes."""

from __future__ import annotations

import base64
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.pieces import chunks, text_of
from larder.sources import stage

#: Characters per chunk, and further characters that it shares with the next.
CHUNK = 1 << 16
OVERLAP = 1 << 11
#: No alternative of the pattern looks further than this past its end.
LOOKAHEAD = 4


class Encoder:
    """A rank file and a pre-token pattern, as tasks use them."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.own = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token

    def packed(self, text: str) -> bytes:
        """Ids, four bytes each, of a text that begins at a pre-token boundary
        and either ends the document or ends at a boundary behind a non-space.

        Such a text has the pre-tokens that it has inside its document: only
        whitespace is matched in view of what follows it.
        """
        return np.array(self.own.encode_ordinary(text), "<i4").tobytes()

    def bounds(self, text: str) -> list[int]:
        """Where a scan from the start of ``text`` puts pre-token boundaries."""
        return [0, *(m.end() for m in self.pattern.finditer(text))]


@cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _lists(packed: list[bytes]) -> pa.Array:
    """Packed ids as a list array."""
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int64)
    values = pa.array(np.frombuffer(b"".join(packed), "<i4"))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def _encode_long(long_docs: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``(doc, ids)`` of texts in chunks: scan all, stitch, encode the pieces."""

    @F.arrow_udf("head array<int>, tail array<int>")
    def scan(parts: pa.Array) -> pa.Array:
        heads, tails = [], []
        for part in parts:
            text = text_of(part)
            bounds = encoder(path, pattern).bounds(text)
            trusted = len(text) - LOOKAHEAD
            heads.append([b for b in bounds if b < overlap])
            tails.append([b - chunk for b in bounds if chunk <= b <= trusted and not text[b - 1].isspace()])
        ints = pa.list_(pa.int32())
        return pa.StructArray.from_arrays([pa.array(heads, ints), pa.array(tails, ints)], ["head", "tail"])

    @F.arrow_udf("array<int>")
    def encode_piece(parts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        own = encoder(path, pattern)
        rows = zip(parts, starts.to_pylist(), ends.to_pylist(), strict=True)
        return _lists([own.packed(text_of(part)[start:end]) for part, start, end in rows])

    @F.arrow_udf("array<int>")
    def encode_whole(parts: pa.Array) -> pa.Array:
        own = encoder(path, pattern)
        whole = ["".join(text_of(p)[:chunk] for p in row) for row in parts]
        return _lists([own.packed(text) for text in whole])

    rows = long_docs.withColumn("uid", F.monotonically_increasing_id())
    parts = stage(chunks(rows, chunk, overlap), "chunks").repartition("uid", "idx")
    scanned = parts.select("uid", "idx", scan("part").alias("at"))
    order = Window.partitionBy("uid").orderBy("idx")
    agreed = F.array_min(F.array_intersect(F.lag("at.tail").over(order), "at.head"))
    starts = scanned.select("uid", "idx", F.when(F.col("idx") == 0, 0).otherwise(agreed).alias("start"))
    ends = starts.select("uid", "idx", "start", (F.lead("start").over(order) + chunk).alias("end"))
    all_agree = F.min(F.col("start").isNotNull()).over(Window.partitionBy("uid"))
    cuts = stage(ends.withColumn("stitched", all_agree), "cuts")
    pieces = parts.join(cuts, ["uid", "idx"])
    encoded = pieces.where("stitched").select("uid", "doc", "idx", encode_piece("part", "start", "end").alias("ids"))
    in_order = F.array_sort(F.collect_list(F.struct("idx", "ids")))["ids"]
    stitched = encoded.groupBy("uid").agg(F.first("doc").alias("doc"), F.flatten(in_order).alias("ids"))
    rest = pieces.where("not stitched").groupBy("uid").agg(
        F.first("doc").alias("doc"), F.array_sort(F.collect_list(F.struct("idx", "part")))["part"].alias("parts")
    )
    return stitched.select("doc", "ids").unionByName(rest.select("doc", encode_whole("parts").alias("ids")))


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``(key, ids)`` of every row: the token ids of its whole text.

    ``path`` is a tiktoken rank file that every executor can open, ``pattern``
    splits pre-tokens; there are no special tokens. Longer texts are cut into
    chunks that overlap. Each is pre-tokenised by itself; neighbours are stitched
    at the first boundary that both put behind a non-space character, from where
    a scan cannot differ. Then each piece between two stitches is encoded. A
    text with a seam where no boundary agrees, as in a run of one letter longer
    than the overlap, is encoded as a whole. A text of one chunk needs no stitch
    and no shuffle. The pattern must not look back, nor ahead beyond
    ``LOOKAHEAD`` characters other than whitespace.

    Null and empty texts give no ids; invalid UTF-8 is read as U+FFFD. Rows with
    the same key stay separate. Other columns are not read.
    """
    if overlap <= LOOKAHEAD or chunk < overlap:
        raise ValueError("a chunk must be at least as long as the overlap, and that longer than the lookahead")

    @F.arrow_udf("array<int>")
    def encode_short(texts: pa.Array) -> pa.Array:
        own = encoder(path, pattern)
        return _lists([own.packed(text_of(text)) for text in texts])

    read = docs.select(F.col(key).alias("doc"), F.col(text).cast("binary").alias("text"))
    is_long = F.coalesce(F.octet_length("text") > chunk, F.lit(False))
    short = read.where(~is_long).select("doc", encode_short("text").alias("ids"))
    long_ids = _encode_long(read.where(is_long), path, pattern, chunk, overlap)
    return short.unionByName(long_ids).withColumnRenamed("doc", key)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of token ids, joined; null for null, empty for none.

    Bytes of one character may come from several tokens, so the result is
    binary. Raises for an id outside the vocabulary.
    """

    @F.arrow_udf("binary")
    def joined(rows: pa.Array) -> pa.Array:
        table = encoder(path, pattern).bytes
        lists = (row.values.to_numpy(zero_copy_only=False) if row.is_valid else None for row in rows)
        return pa.array([None if x is None else b"".join([table[i] for i in x.tolist()]) for x in lists], pa.binary())

    return joined(ids)

"""SimHash near-duplicate detection by a segment-popcount embedding."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.graph import components
from larder.sources import stage

SEED = 42
SEGMENT_BITS = 2
HALF_SEGMENTS = 32 // SEGMENT_BITS
LARGEST_DISTANCE = 3

_LOW = 0x5555555555555555  # the low bit of every segment
_BLOCK = 1 << 16


def _fingerprint(text: bytes | None, width: int) -> int:
    words = (text or b"").lower().split()  # on bytes: A-Z alone, and \x20 \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(width, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1]
    ends = ends[width - 1 :]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _BLOCK):
        spans = map(slice, starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist())
        hashes = map(xxhash.xxh64_intdigest, map(joined.__getitem__, spans), itertools.repeat(SEED))
        block = np.fromiter(hashes, "<u8")
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = counts * 2 > len(starts)
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, width: int = 3) -> Column:
    """The 64-bit SimHash of a text's word shingles, as a long.

    Words are lower-cased in A-Z only. A text with fewer words than the width
    is one shingle; one without words, or null, has fingerprint 0. Works on
    bytes, in blocks, so text of any length or encoding is accepted.
    """

    @F.arrow_udf("long")
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([_fingerprint(t.as_py(), width) for t in texts], pa.int64())

    return hashed(text.cast("binary"))


def embedding(bits: Column) -> Column:
    """The per-segment bit counts of a fingerprint, each count in unary.

    A segment with one bit set becomes 01, with two bits 11. So the Manhattan
    distance of two count vectors is the popcount of their exclusive or, and it
    is never above the fingerprints' Hamming distance.
    """
    high = F.shiftrightunsigned(bits, 1)
    some = bits.bitwiseOR(high).bitwiseAND(F.lit(_LOW))
    both = bits.bitwiseAND(high).bitwiseAND(F.lit(_LOW))
    return some.bitwiseOR(F.shiftleft(both, 1))


def _halves(counts: Column) -> Column:
    """The two halves of an embedding: cells of unit width in 16 dimensions."""
    mask = F.lit(0xFFFFFFFF)
    return F.array(
        F.struct(F.lit(0).alias("half"), counts.bitwiseAND(mask).alias("cell")),
        F.struct(F.lit(1).alias("half"), F.shiftrightunsigned(counts, 32).alias("cell")),
    )


def _reached(cell: Column) -> Column:
    """The cell itself, and the cells one count further along one dimension."""

    def further(low: int) -> Column:
        empty = cell.bitwiseAND(F.lit(1 << low)) == 0
        return cell.bitwiseOR(F.when(empty, F.lit(1 << low)).otherwise(F.lit(2 << low)))

    return F.array_distinct(F.array(cell, *(further(SEGMENT_BITS * i) for i in range(HALF_SEGMENTS))))


def links(prints: DataFrame, distance: int = LARGEST_DISTANCE) -> DataFrame:
    """Pairs ``(u, v)`` of different fingerprints ``bits`` within the distance.

    Grid range join: of two points within Manhattan distance 3, one half of the
    dimensions differs by 1 at most. So each point looks, for both halves, in
    its own cell and in those one step up; the pair whose other member lies one
    step down is found from there. The bound over all dimensions and the exact
    Hamming distance follow. ``prints`` must hold each fingerprint once.
    """
    if not 0 <= distance <= LARGEST_DISTANCE:
        raise ValueError(f"distance must be from 0 to {LARGEST_DISTANCE}")
    counts = prints.select("bits", embedding(F.col("bits")).alias("counts"))
    placed = counts.select("bits", "counts", F.inline(_halves(F.col("counts"))))
    home = placed.select("half", "cell", F.col("bits").alias("u"), F.col("counts").alias("u_counts"))
    looking = placed.select(
        "half",
        F.explode(_reached(F.col("cell"))).alias("cell"),
        F.col("cell").alias("own"),
        F.col("bits").alias("v"),
        F.col("counts").alias("v_counts"),
    )
    once = (F.col("cell") != F.col("own")) | (F.col("u") < F.col("v"))
    bound = F.bit_count(F.col("u_counts").bitwiseXOR(F.col("v_counts"))) <= distance
    exact = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    found = looking.join(home, ["half", "cell"]).where(once & bound & exact)
    return found.select("u", "v").distinct()


def _identity(key: str, text: str) -> list[Column]:
    """128 bits that name a row by its key and text, null or not."""
    a, b = F.col(key), F.col(text)
    return [F.xxhash64(a, b).alias("d1"), F.xxhash64(b, F.lit("row"), a).alias("d2")]


def _members(docs: DataFrame, key: str, text: str, width: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """``(doc, d1, d2, bits)`` of all rows, and ``(bits, root, name)`` of all fingerprints."""
    read = docs.select(F.col(key).alias("doc"), *_identity(key, text), fingerprint(F.col(text), width).alias("bits"))
    hashed = stage(read, "simhash")
    prints = stage(hashed.groupBy("bits").agg(F.min("doc").alias("doc")), "fingerprints")
    found = components(links(prints, distance)).select(F.col("node").alias("bits"), "component")
    root = F.coalesce("component", "bits").alias("root")
    rooted = stage(prints.join(found, "bits", "left").select("bits", "doc", root), "rooted")
    names = stage(rooted.groupBy("root").agg(F.min("doc").alias("name")), "names")
    return hashed, stage(rooted.join(names, "root").select("bits", "root", "name"), "members")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 3,
    distance: int = LARGEST_DISTANCE,
) -> DataFrame:
    """One row per document: its key, ``fingerprint`` and ``component_id``.

    Documents link where their fingerprints differ in ``distance`` bits or less
    (3 at most); the component is the smallest key reachable. Fingerprints are
    compared once each, however many documents share one. Rows with the same
    key are separate documents; a null key is kept, and names a component only
    if there is no other. Null and empty texts have fingerprint zero and link
    like any other. Other columns are not read.
    """
    hashed, members = _members(docs, key, text, width, distance)
    return hashed.join(members, "bits").select(
        F.col("doc").alias(key),
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.col("name").alias("component_id"),
    )


def first_of_each(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 3,
    distance: int = LARGEST_DISTANCE,
) -> DataFrame:
    """The rows of ``docs`` that stand for their component: the smallest key's.

    Of several rows of that key in a component one stays; rows of one key in
    different components are separate documents. A component whose keys are all null
    keeps one row. All columns are returned, whatever their names. Texts are fingerprinted
    once, and the rows that stay are found by key and hash.
    """
    hashed, members = _members(docs, key, text, width, distance)
    order = F.struct(F.col("doc").isNull().alias("nameless"), "doc", "d1", "d2")
    first = hashed.join(members, "bits").groupBy("root").agg(F.min(order).alias("first"))
    kept = stage(first.select("first.d1", "first.d2"), "kept-rows")
    rows = docs.select(F.struct("*").alias("row"), *_identity(key, text)).join(kept, ["d1", "d2"], "left_semi")
    # Rows may be equal in key and text.
    return rows.dropDuplicates(["d1", "d2"]).select("row.*")

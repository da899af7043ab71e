"""Language identification by hyperdimensional n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.pieces import text_of

DIMENSIONS = 1024
GRAM = 3
SEED = 20_011
UNKNOWN = "und"
#: Prototypes are one row per language; more languages than this are refused.
MOST_LANGUAGES = 4096
#: Letters, and texts, whose n-grams are counted together.
BLOCK_LETTERS, BLOCK_TEXTS = 1 << 18, 64
_GRAMS_AT_ONCE = 4096
_BITS = 21  # of a code point


class Profiles(NamedTuple):
    """Languages in order, and a prototype of unit length for each."""

    languages: tuple[str, ...]
    vectors: np.ndarray


@cache
def _lower_letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, np.int64)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


@lru_cache(maxsize=16_384)
def _letter_vector(letter: int, shift: int) -> np.ndarray:
    """A random vector of signs for a letter, permuted by its place in the n-gram."""
    signs = np.random.Generator(np.random.Philox(key=[SEED, letter])).integers(0, 2, DIMENSIONS) * 2 - 1
    return np.roll(signs.astype(np.int8), shift)


def letters(text: str) -> np.ndarray:
    """Lower-case letters of a text; each run of anything else is one 0, also at the ends."""
    codes = _lower_letters()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
    codes = np.concatenate(([0], codes, [0]))
    kept = codes != 0
    kept[1:] |= codes[:-1] != 0
    kept[0] = True
    return codes[kept]


def _gram_vectors(grams: np.ndarray) -> np.ndarray:
    """The bound vectors of n-grams: products of their permuted letter vectors."""
    bound = np.ones((len(grams), DIMENSIONS), np.int8)
    for place in range(GRAM):
        found, where = np.unique(grams >> _BITS * place & (1 << _BITS) - 1, return_inverse=True)
        bound *= np.stack([_letter_vector(int(x), place) for x in found])[where]
    return bound


def _bundles(owners: np.ndarray, grams: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` owners the sum of its n-grams' vectors; exact, as all are integers."""
    found, where = np.unique(grams, return_inverse=True)
    sums = np.zeros((n, DIMENSIONS), np.float64)
    counts = np.bincount(owners * len(found) + where, minlength=n * len(found)).reshape(n, -1).astype(np.float32)
    for at in range(0, len(found), _GRAMS_AT_ONCE):
        vectors = _gram_vectors(found[at : at + _GRAMS_AT_ONCE]).astype(np.float32)
        sums += counts[:, at : at + _GRAMS_AT_ONCE] @ vectors
    return sums


def _blocks(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Bounded blocks ``(first text, owners, n-grams)``; a long text spans several."""
    first, owners, grams, size = 0, [], [], 0
    for i, text in enumerate(texts):
        if size and (i - first >= BLOCK_TEXTS or size + len(text) > BLOCK_LETTERS):
            yield first, np.concatenate(owners), np.concatenate(grams)
            owners, grams, size = [], [], 0
        if not size:
            first = i
        codes = letters(text)
        if not codes.any():
            continue
        gram = sum(codes[GRAM - 1 - p : len(codes) - p] << _BITS * p for p in range(GRAM))
        for at in range(0, len(gram), BLOCK_LETTERS):
            piece = gram[at : at + BLOCK_LETTERS]
            if at:
                yield first, np.concatenate(owners), np.concatenate(grams)
                owners, grams, first = [], [], i
            owners.append(np.full(len(piece), i - first))
            grams.append(piece)
            size += len(piece)
    if owners:
        yield first, np.concatenate(owners), np.concatenate(grams)


def document_vectors(texts: list[str]) -> np.ndarray:
    """One bundle per text; zero for a text without letters."""
    vectors = np.zeros((len(texts), DIMENSIONS))
    for first, owners, grams in _blocks(texts):
        n = int(owners.max()) + 1
        vectors[first : first + n] += _bundles(owners, grams, n)
    return vectors


def _unit(vectors: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Prototypes from all rows with a language: the bundle of all their n-grams.

    Each task adds up its rows, so one row per task and language is shuffled and
    a language with most of the rows costs no more than another. The driver gets
    the finished prototypes only, of at most ``MOST_LANGUAGES`` languages. Rows
    with a null language or text, or without letters, teach nothing.
    """

    def add_up(batches):
        sums: dict[str, np.ndarray] = {}

        def flush():
            names = sorted(sums)
            rows = pa.array([sums[x].astype(np.int64).tolist() for x in names], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), rows], ["lang", "bundle"])

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            texts = [text_of(t) for t in batch.column("text")]
            for name in set(langs):
                bundle = document_vectors([t for t, x in zip(texts, langs, strict=True) if x == name]).sum(axis=0)
                sums[name] = sums.get(name, 0) + bundle
            if len(sums) > MOST_LANGUAGES:
                yield flush()
                sums.clear()
        yield flush()

    read = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    read = read.select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text"))
    partial = read.mapInArrow(add_up, "lang string, bundle array<long>")
    places = partial.select("lang", F.posexplode("bundle").alias("place", "x"))
    summed = places.groupBy("lang", "place").agg(F.sum("x").alias("x"))
    in_order = F.array_sort(F.collect_list(F.struct("place", "x")))["x"]
    rows = summed.groupBy("lang").agg(in_order.alias("bundle")).limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    rows = sorted((row for row in rows if any(row.bundle)), key=lambda row: row.lang.encode())
    bundles = np.array([row.bundle for row in rows], np.float64).reshape(len(rows), DIMENSIONS)
    return Profiles(tuple(row.lang for row in rows), _unit(bundles))


def predict(text: Column, profiles: Profiles) -> Column:
    """``(lang, score)`` of a text: the prototype with the greatest cosine, and that cosine.

    Equal cosines go to the language first by code point; a negative cosine
    scores 0. A null text, one without letters, or no prototypes give
    ``UNKNOWN`` and 0. Texts of any length are read whole, in blocks.
    """

    @F.arrow_udf("lang string, score double")
    def nearest(texts: pa.Array) -> pa.Array:
        names = [UNKNOWN] * len(texts)
        scores = np.zeros(len(texts))
        if profiles.languages:
            for at in range(0, len(texts), BLOCK_TEXTS):
                vectors = document_vectors([text_of(t) for t in texts[at : at + BLOCK_TEXTS]])
                cosines = _unit(vectors) @ profiles.vectors.T
                for i in np.flatnonzero(vectors.any(axis=1)):
                    best = int(cosines[i].argmax())
                    names[at + i] = profiles.languages[best]
                    scores[at + i] = min(1.0, max(0.0, float(cosines[i, best])))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang", "score"])

    return nearest(text.cast("binary"))

from __future__ import annotations

import zlib
from collections import Counter
from functools import cache

import numpy as np
from pyspark.sql import functions as F

from larder.llm import language, queries


def test_held_out_accuracy(spark):
    rows = queries.op3_language(spark, "/root/testdata/sf0.01")
    truth = queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang", F.length("text").alias("n"))
    held = rows.join(truth, "doc_id").where("held_out and lang is not null and n > 40").collect()
    assert len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in held)


def test_blocks_do_not_matter(monkeypatch):
    texts = ["Das ist ein Satz.", "", "123 !!", "ça va très bien " * 40, "x", "the end of it " * 90]
    whole = language.document_vectors(texts)
    plain = [sum((language._gram_vectors(np.array([g]))[0].astype(float) for g in _grams(t)), np.zeros(language.DIMENSIONS)) for t in texts]
    assert np.array_equal(whole, np.array(plain))
    monkeypatch.setattr(language, "BLOCK_LETTERS", 50)
    monkeypatch.setattr(language, "BLOCK_TEXTS", 2)
    assert np.array_equal(language.document_vectors(texts), whole)


def _grams(text):
    codes = language.letters(text)
    if not codes.any():
        return []
    bits = language._BITS
    return [int(a) << 2 * bits | int(b) << bits | int(c) for a, b, c in zip(codes, codes[1:], codes[2:], strict=False)]


def plain_letters(text):
    found = [0]
    for char in text:
        if char.isalpha():
            found.append(ord(char.lower()) if len(char.lower()) == 1 else ord(char))
        elif found[-1]:
            found.append(0)
    return found if not found[-1] else [*found, 0]


@cache
def plain_vector(gram):
    return np.prod([np.roll(language._letter_vector(x, 0), 2 - i) for i, x in enumerate(gram)], axis=0).astype(float)


def plain_bundle(text):
    own = plain_letters(text or "")
    grams = Counter(zip(own, own[1:], own[2:], strict=False))
    return sum((n * plain_vector(gram) for gram, n in grams.items()), np.zeros(language.DIMENSIONS))


def test_query_equals_plain_version(spark, sf_dir):
    rows = queries.table(spark, sf_dir, "documents").collect()
    bundles = {r.doc_id: plain_bundle(r.text) for r in rows}
    sums = {}
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang is not None:
            sums[r.lang] = sums.get(r.lang, 0) + bundles[r.doc_id]
    names = sorted(sums)
    prototypes = np.array([sums[x] / np.linalg.norm(sums[x]) for x in names])
    got = {r.doc_id: r for r in queries.op3_language(spark, sf_dir).collect()}
    assert set(got) == set(bundles)
    for doc, bundle in bundles.items():
        assert got[doc].held_out == (zlib.crc32(str(doc).encode()) % 3 == 1)
        if not bundle.any():
            assert (got[doc].lang_pred, got[doc].score) == ("und", 0)
            continue
        cosines = prototypes @ bundle / np.linalg.norm(bundle)
        assert got[doc].lang_pred == names[cosines.argmax()]
        assert abs(got[doc].score - max(0, cosines.max())) < 1e-9


def test_edge_cases(spark, texts):
    rows = [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), (None, "en"), ("le chat", None), ("...", "xx")]
    profiles = language.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert profiles.languages == ("de", "en")
    docs = texts("the dog and", "und der", None, "", "12 34", "the " * 300_000)
    got = [tuple(r[0]) for r in docs.select(language.predict(F.col("text"), profiles)).collect()]
    assert [g[0] for g in got] == ["en", "de", "und", "und", "und", "en"]
    assert [g[1] for g in got[2:5]] == [0, 0, 0]
    nothing = language.learn(spark.createDataFrame([], "text string, lang string"))
    assert [tuple(r[0]) for r in docs.limit(1).select(language.predict(F.col("text"), nothing)).collect()] == [("und", 0)]
    assert docs.limit(0).select(language.predict(F.col("text"), profiles)).count() == 0

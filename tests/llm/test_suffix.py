from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from llm import brute

from larder.llm import queries, suffix


def check(docs, found, length, keep):
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    texts = [(r.text or "").encode() for r in rows]
    got = {r.row.doc_id: r for r in found.collect()}
    assert len(got) == len(rows)
    for row, text, (anywhere, earlier) in zip(rows, texts, brute.duplicated_bytes(texts, length), strict=True):
        removed = anywhere if keep == "none" else earlier
        mine = got[row.doc_id]
        assert [(s.start, s.end) for s in mine.removed] == brute.runs(removed)
        assert bytes(mine.kept) == bytes(b for i, b in enumerate(text) if i not in removed)
        assert mine.n_bytes == len(text)


def repetitive(seed, n=60, size=160, alphabet="ab c"):
    """Texts that share pieces of each other, and repeat themselves."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, 60))) for _ in range(25)]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, size // 20))) for _ in range(n)]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group", [512, 1])
def test_equals_brute_force(texts, monkeypatch, keep, group):
    monkeypatch.setattr(suffix, "GROUP", group)
    values = [*repetitive(1), *repetitive(2, alphabet="abcdefghijklmnop "), "ab" * 100, "x" * 150, "é" * 60, None, "", "ab" * 100]
    docs = texts(*values)
    check(docs, suffix.remove_repeats(docs, length=40, keep=keep), 40, keep)


def test_blocks_do_not_matter(texts, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK", 50)
    values = repetitive(3)
    found = [suffix._anchored([v.encode()], 40) for v in values]
    monkeypatch.undo()
    for value, cut in zip(values, found, strict=True):
        whole = suffix._anchored([value.encode()], 40)

        def windows(columns):
            return {p for lo, hi in zip(columns[1], columns[2], strict=True) for p in range(lo, hi + 1)}

        assert windows(cut) == windows(whole) == set(range(max(0, len(value) - 39)))


def test_query_equals_brute_force(spark, sf_dir):
    rows = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r.doc_id)
    texts = [(r.text or "").encode() for r in rows]
    got = {r.doc_id: r for r in queries.op4_repeated_bytes(spark, sf_dir).collect()}
    for row, text, (anywhere, _) in zip(rows, texts, brute.duplicated_bytes(texts, 400), strict=True):
        kept = bytes(b for i, b in enumerate(text) if i not in anywhere)
        mine = got[row.doc_id]
        assert (mine.n_bytes, mine.n_removed, mine.n_spans) == (len(text), len(anywhere), len(brute.runs(anywhere)))
        assert mine.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert any(r.n_removed for r in got.values())


def shared_bytes(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))


@pytest.mark.parametrize("length", [1, 3, 7, 8, 9, 40, 100])
@pytest.mark.parametrize("made", [b"abcabcabx" * 30, b"a" * 250, bytes(range(256)), None])
def test_longest_previous_factors_equal_brute_force(length, made):
    rng = random.Random(length)
    made = made or bytes(rng.choice(b"ab\x00") for _ in range(300))
    text = np.frombuffer(made, np.uint8)
    places = np.arange(len(text) - length + 1)
    strings = [made[p : p + length] for p in places]
    order, shared = suffix.suffix_order(text, places, length)
    assert order.tolist() == sorted(places.tolist(), key=lambda p: (strings[p], p))
    assert shared[1:].tolist() == [shared_bytes(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)]
    for least in (1, length):
        lengths, sources = suffix.previous_factors(order, shared, least)
        for place, long, source in zip(order.tolist(), lengths.tolist(), sources.tolist(), strict=True):
            best = max((shared_bytes(strings[place], strings[j]) for j in range(place)), default=0)
            assert long == (best if best >= least else 0)
            assert source == -1 if not long else (source < place and shared_bytes(strings[place], strings[source]) >= long)


def test_places_need_not_be_neighbours():
    text = np.frombuffer(b"xxabcd--abcdabcd", np.uint8)
    order, shared = suffix.suffix_order(text, np.array([2, 8, 12]), 4)
    assert (order.tolist(), shared.tolist()) == ([2, 8, 12], [0, 4, 4])
    assert suffix.previous_factors(order, shared)[1].tolist() == [-1, 2, 8]


def test_nothing_and_null_keys(texts):
    docs = texts(None, "", "short", ids=[None, None, 1])
    assert [r.removed for r in suffix.remove_repeats(docs).collect()] == [[], [], []]
    assert suffix.remove_repeats(docs.limit(0)).count() == 0
    twice = texts("word " * 30, "word " * 30, ids=[None, None])
    assert [len(r.kept) for r in suffix.remove_repeats(twice, length=100, keep="none").collect()] == [0, 0]

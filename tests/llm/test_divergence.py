from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
from compare import differences, open_duckdb
from pyspark.sql import functions as F

from larder.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_version(rows, least):
    counts, docs, groups = Counter(), Counter(), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        own = Counter(TERM.findall((text or "").translate(LOWER)))
        counts.update({(lang, source, t): n for t, n in own.items()})
        docs.update({(lang, t): 1 for t in own})
    found = []
    for lang, sources in groups.items():
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least]
        rest = 2 * len(kept)
        sums = {s: sum(counts[lang, s, t] for t in kept) for s in sources}
        p = {(s, t): 1 + 10**9 * (counts[lang, s, t] + 2) // (sums[s] + rest) for s in sources for t in kept}
        all_of = {t: sum(counts[lang, s, t] for s in sources) for t in kept}
        q = {t: 1 + 10**9 * (n + 2) // (sum(all_of.values()) + rest) for t, n in all_of.items()}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            parts = {
                "pair": [(o, sum(f(p[s, t], p[o, t]) for t in kept)) for o in sources if o != s],
                "term": [(t, f(p[s, t], q[t])) for t in kept if counts[lang, s, t] and p[s, t] > q[t]],
            }
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                items = items[:10] if part == "term" else items
                found += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(items, 1)]
    return sorted(found)


def made_rows():
    rng = random.Random(8)
    words = ["The", "THE", "café", "Ünder", "漢字", "a1b", "x-y", "_q_", "🙂", "ties", "Ties"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "é", None])) for _ in range(200)]
    rows += [(None, "en", "a"), ("", "xx", "only"), ("rare word", "yy", "s"), ("other", "yy", "t")]
    rows += [("hot " * 400_000, "en", "a")] + [("copied line of words", "en", "b")] * 30
    return rows


def test_equals_plain_version(spark):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", F.lit("clash"))
    for least in (1, 4):
        got = sorted(map(tuple, divergence.audit(docs, min_documents=least).collect()))
        assert got == plain_version(rows, least)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(divergence, "HELD_ROWS", 5)
    monkeypatch.setattr(divergence, "BLOCK_ROWS", 3)
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 7)
    assert sorted(map(tuple, divergence.audit(docs, min_documents=2).collect())) == plain_version(rows, 2)


def test_long_division_is_exact():
    rng = random.Random(2)
    sums = [rng.randint(1, 1 << rng.randint(3, 52)) for _ in range(2000)]
    counts = [rng.randint(0, max(0, s - 2)) for s in sums]
    got = divergence.probabilities(np.array(counts), np.array(sums))
    assert got.tolist() == [1 + 10**9 * (c + 2) // s for c, s in zip(counts, sums, strict=True)]


def test_batches_count_documents_once():
    batch = pa.RecordBatch.from_pydict({"text": pa.array([b"a a b", b"a \xff\xfe", b""], pa.binary()), "lang": ["x", "x", "y"], "source": ["s", "s", "s"]})
    rows = {tuple(r[c] for c in ("lang", "source", "term")): (r["n"], r["docs"]) for r in divergence._batch_counts(batch).to_pylist()}
    assert rows["x", "s", b"a"] == (3, 2) and rows["x", "s", b"b"] == (1, 1)
    assert {k for k, v in rows.items() if not k[2]} == set(product("xy", "s", [b""]))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(docs).count() == 0


def test_query_equals_sql(spark, sf_dir):
    assert differences(queries.op12_source_divergence(spark, sf_dir), open_duckdb(sf_dir), divergence.oracle_sql()) == []

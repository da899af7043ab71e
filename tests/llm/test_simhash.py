from __future__ import annotations

import random

from llm import brute
from pyspark.sql import functions as F

from larder.llm import queries, simhash


def signed(bits):
    return bits - (1 << 64) if bits >> 63 else bits


def test_query_equals_brute_force(spark, sf_dir):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r.doc_id)
    prints = [brute.fingerprint(r.text) for r in docs]
    roots = brute.groups(prints, 3)
    found = {r.doc_id: r for r in queries.op1_simhash_groups(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for i, row in enumerate(docs):
        assert found[row.doc_id].fingerprint == f"{prints[i]:016x}"
        assert found[row.doc_id].component_id == docs[roots[i]].doc_id


def test_links_equal_all_pairs(spark):
    rng = random.Random(4)
    prints = {0, 1, 7, (1 << 64) - 1, (1 << 64) - 8, 1 << 63}
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(6):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    frame = spark.createDataFrame([(signed(p),) for p in prints], "bits long")
    for distance in range(4):
        found = {tuple(sorted(r)) for r in simhash.links(frame, distance).collect()}
        every = sorted(map(signed, prints))
        mask = (1 << 64) - 1
        wanted = {(a, b) for a in every for b in every if a < b and ((a ^ b) & mask).bit_count() <= distance}
        assert found == wanted


def test_embedding_is_a_lower_bound(spark):
    rng = random.Random(5)
    rows = [tuple(signed(rng.getrandbits(64)) for _ in range(2)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a long, b long")
    gap = F.bit_count(simhash.embedding(F.col("a")).bitwiseXOR(simhash.embedding(F.col("b"))))
    assert df.where(gap > F.bit_count(F.col("a").bitwiseXOR(F.col("b")))).count() == 0
    counts = [sum(abs((a >> s & 1) + (a >> s + 1 & 1) - (b >> s & 1) - (b >> s + 1 & 1)) for s in range(0, 64, 2)) for a, b in rows]
    assert [r[0] for r in df.select(gap).collect()] == counts


def test_edge_cases(texts):
    docs = texts(None, "", "  \t", "one", "ONE", "one two three four", "x " * 70_000, None, ids=[5, 3, 9, 1, 2, 4, 8, None])
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(docs).collect()}
    zero = "0" * 16
    assert [found[i, zero] for i in (5, 3, 9, None)] == [3, 3, 3, 3]
    assert {i: c for (i, f), c in found.items() if f != zero} == {1: 1, 2: 1, 4: 4, 8: 8}
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 8]
    assert simhash.near_duplicates(docs.limit(0)).count() == simhash.first_of_each(docs.limit(0)).count() == 0


def test_repeated_rows_and_null_keys(texts):
    docs = texts("a b c d", "a b c d", "e f g h", "e f g h", ids=[1, 1, None, None])
    assert simhash.near_duplicates(docs).count() == 4
    assert sorted(str(r.doc_id) for r in simhash.first_of_each(docs).collect()) == ["1", "None"]


def test_one_key_with_texts_of_different_components(texts):
    docs = texts("one two three four five", "six seven eight nine ten", "six seven eight nine ten", "red green blue", ids=[0, 0, 1, 1])
    kept = sorted((r.doc_id, r.text) for r in simhash.first_of_each(docs).collect())
    assert kept == [(0, "one two three four five"), (0, "six seven eight nine ten"), (1, "red green blue")]

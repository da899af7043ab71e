from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import passages, queries

SF_DIR = "/root/testdata/sf0.01"


def area_under_curve(scores, y):
    scores, y = np.array(scores), np.array(y)
    good, bad = scores[y == 1], scores[y == 0]
    return float((good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean())


def test_held_out_accuracy(spark):
    rows = queries.op13_quality_score(spark, SF_DIR)
    assert rows.count() == queries.table(spark, SF_DIR, "documents").count()
    held = rows.join(queries.table(spark, SF_DIR, "labels"), "doc_id").where("held_out").collect()
    assert len(held) > 60
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in held)
    assert area_under_curve([r.score for r in held], [r.quality for r in held]) > 0.95
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.93


def plain_features(text: bytes):
    """One passage at a time, one byte at a time."""
    n = passages.passage_count(len(text))
    rows = []
    padded = b"\n\n" + text
    for k in range(n):
        start, end = k * 512, len(text) if k == n - 1 else (k + 1) * 512
        pairs, triples = np.zeros(64), np.zeros(256)
        for at in range(start + 2, end + 2):
            a, b, c = padded[at], padded[at - 1], padded[at - 2]
            pairs[passages._KIND[b] * 8 + passages._KIND[a]] += 1
            a, b, c = (bytes([x]).lower()[0] for x in (a, b, c))
            triples[(a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) % 2**32 >> 24] += 1
        own = max(1, end - start)
        rows.append([*np.sqrt(pairs / own), *np.sqrt(triples / own), ((triples / own) ** 2).sum(), (end - start) / 512, np.log1p(len(text))])
    return np.array(rows, np.float32)


def plain_score(model, text: bytes):
    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    e = np.tanh((plain_features(text) - model.mean) / model.scale @ model.embed + model.embed_bias)
    logits = [float((np.tanh(h @ model.tanh) * sigmoid(h @ model.gate)) @ model.attend) for h in e]
    weights = np.exp(np.array(logits) - max(logits))
    z = (weights / weights.sum()) @ e
    return float(sigmoid(z @ model.classify + model.bias[0]))


def some_model():
    rng = np.random.default_rng(1)
    bags = [rng.random((k % 5 + 1, passages.FEATURES)).astype(np.float32) for k in range(40)]
    return passages.train(bags, np.arange(40) % 2.0)


def test_scores_equal_plain_version(monkeypatch):
    model = some_model()
    texts = [b"", b"x", b"Some words. " * 100, "é漢字\n".encode() * 300, b"A" * 255, b"b" * 256, b"c" * 768, bytes(range(256)) * 9]
    wanted = [plain_score(model, t) for t in texts]
    assert np.allclose(passages.scores(model, texts), wanted, atol=1e-9)
    for block in (512, 1024, 4096):
        monkeypatch.setattr(passages, "BLOCK_BYTES", block)
        assert np.allclose(passages.scores(model, texts), wanted, atol=1e-6)


def test_query_equals_plain_version(spark, sf_dir):
    docs, labels = (queries.table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = passages.fit(docs.where(~held_out), labels.where(~held_out))
    got = {r.doc_id: r.score for r in queries.op13_quality_score(spark, sf_dir).collect()}
    some = docs.where("doc_id % 40 = 0").collect()
    assert np.allclose([got[r.doc_id] for r in some], [plain_score(model, (r.text or "").encode()) for r in some], atol=1e-6)


def test_gradients_equal_differences():
    rng = np.random.default_rng(4)
    model = some_model()
    x, starts, y = rng.normal(size=(9, passages.FEATURES)), np.array([0, 1, 4]), np.array([1.0, 0, 1])

    def loss(m):
        total = 0
        for a, b, t in zip(starts, [*starts[1:], len(x)], y, strict=True):
            e = np.tanh(x[a:b] @ m.embed + m.embed_bias)
            w = np.exp(passages._attention(m, e))
            s = passages._sigmoid((w / w.sum()) @ e @ m.classify + m.bias[0])
            total -= np.log(s if t else 1 - s) / len(y)
        return total

    for name, grad in zip(model._fields[2:], passages._gradients(model, x, starts, y), strict=True):
        part = getattr(model, name)
        at = tuple(rng.integers(0, s) for s in part.shape)
        moved = [part.copy(), part.copy()]
        moved[0][at] += 1e-5
        moved[1][at] -= 1e-5
        slope = (loss(model._replace(**{name: moved[0]})) - loss(model._replace(**{name: moved[1]}))) / 2e-5
        assert grad[at] == pytest.approx(slope, rel=1e-3, abs=1e-8)


def test_edge_cases(spark, texts):
    docs = texts(None, "", "fine words here", "%%% &&&", "fine " * 200_000, "fine words here", ids=[1, 2, 3, 4, 5, 3])
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (3, None, 0), (None, 1, 1), (3, 0, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")
    model = passages.fit(docs, labels, max_documents=2)
    got = docs.select("doc_id", passages.score(F.col("text"), model).alias("s")).collect()
    assert len(got) == 6 and all(0 <= r.s <= 1 for r in got)
    by_id = {r.doc_id: r.s for r in got}
    assert by_id[1] == pytest.approx(by_id[2])
    assert passages.fit(docs, labels.limit(0)) is None and passages.fit(docs.limit(0), labels) is None
    assert docs.limit(1).select(passages.score(F.col("text"), None)).first()[0] == passages.NO_SCORE
    assert docs.limit(0).select(passages.score(F.col("text"), model)).count() == 0

from __future__ import annotations

import hashlib
import random
import re

import pytest
from compare import differences, open_duckdb
from pyspark.sql import functions as F

from larder.llm import infill, queries

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_version(key, text, percent=50):
    text = text or ""
    units = UNIT.findall(text)
    name = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(name[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def odd_texts():
    rng = random.Random(5)
    made = [None, "", " ", "\n\t ", "x", " x ", "a<P>b", "<", "a<", "<S", "ends <S", ">P> x", "\x0b\x1f\xa0 né 漢字 🙂 ", "a b " * 100_000]
    made += ["w" * 300_000 + " é" * 70_000, "é" * 200_000, "same text here"] + ["same text here"] * 3
    made += ["".join(rng.choice("ab <SPM>\n\té🙂") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    return made


@pytest.mark.parametrize("limit", [(4096, 1 << 16), (1, 2), (3, 1)])
def test_equals_plain_version(texts, monkeypatch, limit):
    monkeypatch.setattr(infill, "PIECE_UNITS", limit[0])
    monkeypatch.setattr(infill, "PIECE_BYTES", limit[1])
    made = [t for t in odd_texts() if limit[0] > 99 or len(t or "") < 1000]
    ids = [None if i % 50 == 7 else i // 2 for i in range(len(made))]
    docs = texts(*made, ids=ids).withColumn("row", F.lit("clash")).withColumn("at", F.lit("clash"))
    wanted = [(i, *plain_version(i, t, 90), t or "") for i, t in zip(ids, made, strict=True)]
    got = sorted(map(tuple, infill.digests(docs, fim_percent=90).collect()), key=repr)
    assert got == sorted(((*w[:5], sha(w[5]), sha(w[6])) for w in wanted), key=repr)
    if limit[0] > 99:
        assert {w[2] for w in wanted} == {"plain", "spm", "psm"}
        rows = infill.transform(docs, fim_percent=90)
        assert sorted(map(tuple, rows.collect()), key=repr) == sorted((w[:6] for w in wanted), key=repr)
        restored = rows.select(infill.restore(F.col("output"), F.col("form"))).collect()
        assert sorted(r[0] for r in restored) == sorted(w[6] for w in wanted)


def test_pieces_are_bounded_and_whole_units(texts):
    docs = texts("word " * 50_000, "w" * 200_000, ids=[1, 2])
    rows = infill.pieces(docs, fim_percent=100).collect()
    assert max(len(r.piece) for r in rows) <= infill.PIECE_BYTES + 3
    assert all(len(infill.unit_ends(bytes(r.piece))) <= infill.PIECE_UNITS + 1 for r in rows)
    assert len(rows) > 12


def test_plain_texts_pass_the_shuffle_whole(texts, monkeypatch):
    """A plain text's digests come from its sorted pieces, like those of the other forms."""
    own, made, text = infill.pieces, [], "wörd  of\n" * 40_000
    monkeypatch.setattr(infill, "pieces", lambda *a, **k: made.append(own(*a, **k)) or made[-1])
    rows = infill.digests(texts(text, "", None), fim_percent=0).orderBy("doc_id").collect()
    assert [(r.form, r.output_sha256, r.restored_sha256) for r in rows] == [("plain", sha(t), sha(t)) for t in (text, "", "")]
    pieces = made[-1].where("doc = 0").orderBy("at").collect()
    assert len(pieces) > 9 and b"".join(bytes(r.piece) for r in pieces) == text.encode()


def test_reader_passes_a_plain_output_on():
    reader = infill.Reader("plain")
    assert [p for piece in (b"a <", b"", b"P> b", b"<S") for p in reader.feed(piece)] == [(0, b"a <"), (0, b"P> b"), (0, b"<S")]


def test_empty_table(texts):
    docs = texts("x").limit(0)
    assert infill.digests(docs).count() == infill.transform(docs).count() == infill.pieces(docs).count() == 0


def test_query_equals_sql(spark, sf_dir):
    assert differences(queries.op11_infill(spark, sf_dir), open_duckdb(sf_dir), infill.oracle_sql()) == []


def test_one_shuffle(texts):
    plan = infill.digests(texts("a b c"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1

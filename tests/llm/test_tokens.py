from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from larder.llm import bpe, counts, queries, transducer

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN
ODD = [*"abXY 's'll12!?\n\t  ", " ", "\x1c", "é", "Σ", "日本", "한", "²", "😀", "<|endoftext|>", "　", "İ", "Ƛ"]


def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("brute", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n, length, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, length))) for _ in range(n)]


def test_round_trip_equals_the_library(spark, sf_dir):
    own = library()
    found = {r.doc_id: r for r in queries.op2_bpe_round_trip(spark, sf_dir).collect()}
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = own.encode_ordinary(row.text or "")
        got = found.pop(row.doc_id)
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
    assert not found


def test_chunks_are_stitched(texts):
    """Small chunks, so that most texts have seams, some of which find no stitch."""
    own = library()
    values = [*odd_texts(150, 400), "a" * 300, "a " * 150, " " * 300, "x\n\n y  z" * 40, "don't we'll " * 30, None, ""]
    ids = {r.doc_id: r.ids for r in bpe.encode(texts(*values), RANKS, PATTERN, chunk=40, overlap=24).collect()}
    assert [ids[i] for i in range(len(values))] == [own.encode_ordinary(v or "") for v in values]


def test_repeated_rows_stay_apart_and_empty_tables_work(texts):
    docs = texts("a b " * 50, "a b " * 50, "c", ids=[1, 1, None])
    assert sorted(str(r.doc_id) for r in bpe.encode(docs, RANKS, PATTERN, chunk=40, overlap=24).collect()) == ["1", "1", "None"]
    assert bpe.encode(docs.limit(0), RANKS, PATTERN).count() == 0
    assert counts.count_tokens(docs.limit(0), WORDS).count() == 0


def test_counts_equal_the_library(spark, sf_dir):
    own = Tokenizer.from_file(WORDS)
    found = {r.doc_id: r for r in queries.op10_token_counts(spark, sf_dir).collect()}
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        n = len(own.encode(row.text or "", add_special_tokens=False))
        got = found.pop(row.doc_id)
        assert (got.n_tokens, got.n_bytes) == (n, len((row.text or "").encode()))
        assert got.over_limit == (n > 2048)
    assert not found


@pytest.mark.parametrize("fan", [2, 16])
def test_counts_of_chunks_compose(texts, monkeypatch, fan):
    monkeypatch.setattr(counts, "FAN", fan)
    own = Tokenizer.from_file(WORDS)
    values = [*odd_texts(200, 300, 2), "a" * 300, None, "", "<|startoftext|>" * 20]
    found = {r.doc_id: r for r in counts.count_tokens(texts(*values), WORDS, chunk=16).collect()}
    assert [found[i].n_tokens for i in range(len(values))] == [len(own.encode(v or "", add_special_tokens=False)) for v in values]
    assert [found[i].n_bytes for i in range(len(values))] == [len((v or "").encode()) for v in values]


def some_words():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeéthing日s") for _ in range(rng.randint(1, 30))) for _ in range(400)]
    return [*words, "", "the" * 20, "ab" * 50, *("a" * n for n in range(1, 40)), *("er" * n + "s" for n in range(1, 20))]


@pytest.mark.parametrize("most", [1 << 17, 40])
def test_transducer_equals_the_library(most):
    """Also when the states do not fit and are compiled again and again."""
    own, whole = counts.transducer(WORDS), Tokenizer.from_file(WORDS)
    merges = list(own.automaton.ranks)[255:]
    automaton = transducer.Automaton(merges, most)
    for word in some_words():
        assert automaton.count(word.encode()) == len(whole.encode(word, add_special_tokens=False))
        assert len(automaton.states) <= most


def test_states_hold_no_text():
    """However long a word, its states are those of its last token's length."""
    own = counts.transducer(WORDS).automaton
    own.count(b"ab" * 20_000)
    assert max(len(places) for _, places in own.states) <= max(own.depth) + 1


def test_tokens_stay_apart_where_merges_keep_them():
    own = counts.transducer(WORDS).automaton
    rng = random.Random(5)
    whole = [i for i in rng.sample(range(len(own.tokens)), 900) if own._is_whole(i)]
    inner = [i for i in whole if not own.tokens[i].endswith(transducer.WORD_END)]
    pairs = [(rng.choice(inner), rng.choice(whole)) for _ in range(4000)]
    pairs += [(a, b) for a in inner[:60] for b in inner[:60] if own.tokens[a][-1:] == own.tokens[b][:1]]
    for a, b in pairs:
        assert own.stays_apart(a, b) == (own.encode(own.tokens[a] + own.tokens[b]) == [own.tokens[a], own.tokens[b]])


def test_composition_is_associative():
    own = counts.transducer(WORDS)
    for text in odd_texts(200, 30, 3):
        a, b, c = (own.state_map(text[i : i + 10]) for i in (0, 10, 20))
        assert own.compose(own.compose(a, b), c) == own.compose(a, own.compose(b, c))


def test_decoding_joins_bytes(spark):
    df = spark.createDataFrame([([0, 1, 50_000],), ([],), (None,)], "ids array<int>")
    with open(RANKS, "rb") as file:
        token = {int(b): base64.b64decode(a) for a, b in map(bytes.split, file)}
    got = [r[0] for r in df.select(bpe.decode(df["ids"], RANKS, PATTERN)).collect()]
    assert [g if g is None else bytes(g) for g in got] == [token[0] + token[1] + token[50_000], b"", None]

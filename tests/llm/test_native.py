from __future__ import annotations

import pytest
from compare import differences, open_duckdb
from pyspark.sql import functions as F

from larder.llm import mixing, quality, queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    return open_duckdb(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLES[name]) == []


def test_quality_counts(texts):
    docs = texts(None, "", "a b c a b c", "a b\n\na b\n \nc", "é# x!", "the " * 60)
    rows = {r.row.doc_id: r for r in quality.judge(docs).collect()}
    assert [rows[i].n_words for i in range(6)] == [0, 0, 6, 5, 2, 60]
    assert [rows[i].n_repeat_words for i in range(6)] == [0, 0, 6, 0, 0, 60]
    assert [rows[i].n_dup_lines for i in range(6)] == [0, 0, 0, 1, 0, 0]
    assert (rows[4].word_chars, rows[4].n_symbols, rows[4].n_shouts) == (4, 1, 1)
    assert all(rows[i].base_failed for i in range(6))
    assert rows[0].row.component == "x"
    assert quality.judge(docs.limit(0)).count() == 0


def test_quality_runs_in_one_projection(texts):
    plan = quality.judge(texts("a"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_clean_prose_stays(texts):
    prose = " ".join(f"the word{i} of item{i * 7} and" for i in range(30))
    shouting = " ".join(f"THE!! WORD{i}!!" for i in range(60))
    symbols = " ".join(f"the word{i}%%%" for i in range(60))
    kept = quality.passing(texts(prose, shouting, symbols))
    assert [r.doc_id for r in kept.collect()] == [0]
    assert "component" in kept.columns


def sources(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, text string, source string, size int, row string")


def test_mix_targets(spark):
    rows = [(i, "w " * 10, "a", 1, "r") for i in range(100)] + [(1000 + i, "w " * 5, "b", 1, "r") for i in range(20)]
    rows += [(2000, "w w", None, 1, "r"), (2001, None, "c", 1, "r"), (2002, "", "c", 1, "r")]
    got = mixing.mix(sources(spark, *rows)).collect()
    size, target, taken = {}, {}, {}
    for r in got:
        s = r.row.source
        size[s], target[s] = r.source_size, r.target
        taken[s] = taken.get(s, 0) + r.size * r.copies
        assert 0 <= r.copies <= 3
    # b, c and the null source reach three times their sizes; a gets the rest.
    assert size == {"a": 1000, "b": 100, "c": 0, None: 2}
    assert target == {"a": 1102 - 306, "b": 300, "c": 0, None: 6}
    assert taken["b"] == 300 and taken[None] == 6 and abs(taken["a"] - 796) <= 5
    assert mixing.mixed(sources(spark, *rows)).columns == ["doc_id", "text", "source", "size", "row"]


def test_mix_of_nothing(spark):
    assert mixing.mix(sources(spark)).count() == 0
    rows = [(1, None, None, 1, "r"), (1, None, None, 1, "r"), (None, "", "a", 1, "r")]
    assert [r.copies * r.size for r in mixing.mix(sources(spark, *rows)).collect()] == [0, 0, 0]


def test_mix_is_repeatable_and_near_its_targets(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    first, second = ({r.row.doc_id: r.copies for r in mixing.mix(docs).collect()} for _ in range(2))
    assert first == second
    largest = max(r.size for r in mixing.mix(docs).collect())
    sums = {}
    for r in mixing.mix(docs).collect():
        entry = sums.setdefault(r.row.source, [0, r.target])
        entry[0] += r.size * r.copies
    assert all(abs(a - b) <= largest for a, b in sums.values())


def test_inclusion_follows_the_odds(spark):
    """In a source of which about a third is wanted, twice as large documents are taken twice as often."""
    rows = [(i, "w " * (1 + i % 4), "a", 1, "r") for i in range(12_000)] + [(99_000 + i, "w " * 60, "b", 1, "r") for i in range(500)]
    rows += [(199_000 + i, "w " * 4, "c", 1, "r") for i in range(1000)]
    got = mixing.mix(sources(spark, *rows)).where("row.source = 'a'").collect()
    rest = got[0].target - got[0].source_size * (got[0].target // got[0].source_size)
    whole = got[0].target // got[0].source_size
    squares = sum(r.size**2 for r in got)
    for size in range(1, 5):
        own = [r.copies - whole for r in got if r.size == size]
        assert sum(own) / len(own) == pytest.approx(rest * size / squares, rel=0.12)


def test_rows_with_one_key_have_places_of_their_own(spark):
    rows = [(None, f"w{i} x y z", "a", 1, "r") for i in range(600)] + [(i, "w " * 30, "b", 1, "r") for i in range(40)]
    got = mixing.mix(sources(spark, *rows)).where("row.source = 'a'").collect()
    assert abs(sum(r.size * r.copies for r in got) - got[0].target) <= 2


def test_words_are_counted(texts):
    made = [None, "", "  ", "a", " a  b\n\n\tc\x0bd ", "é\u00a0x y", "w " * 100_000]
    rows = texts(*made).select(mixing.n_words(F.col("text"))).collect()
    assert [r[0] for r in rows] == [0, 0, 0, 1, 4, 2, 100_000]

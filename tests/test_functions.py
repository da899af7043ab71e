from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from larder.functions import clean_text, first_match, matches, minutes_or, ratio, sentinel

TEXTS = ["", "abc", "ABC", "xabcx", "abcx", "xabc", "a%c", "a_c", "axc", "a\\c", "100%", "%", None]
PATTERNS = ["abc", "%abc%", "abc%", "%abc", "a_c", "%a_c%", "%", "%%", "", "a%c", "%b%c%"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_matches_is_like(frame, pattern):
    df = frame("t string", *((t,) for t in TEXTS))
    found = df.select(matches(F.col("t"), pattern).alias("a"), F.col("t").like(pattern).alias("b"))
    assert all(a == b for a, b in rows(found))


def test_values(frame):
    df = frame("t string, x double", ("a\tb\nc", 0.0), (None, None), ("12.5", 4.0), ("", 2.0), ("?", 1.0))
    out = df.select(
        clean_text(F.col("t")).alias("t"),
        sentinel(F.col("x"), 999.0, [0]).alias("s"),
        minutes_or(F.col("t"), 99).alias("m"),
        ratio(F.lit(1), F.col("x")).alias("r"),
        first_match([(F.col("x") > 3, "big"), (F.col("x") > 1, "mid")], "small").alias("f"),
    )
    assert [tuple(r) for r in out.collect()] == [
        ("abc", 999.0, None, None, "small"),
        (None, 999.0, 99.0, None, "small"),
        ("12.5", 4.0, 12.5, 0.25, "big"),
        ("", 2.0, 99.0, 0.5, "mid"),
        ("?", 1.0, None, 1.0, "small"),
    ]


def test_first_match_without_rules_is_the_default(frame):
    assert rows(frame("x int", (1,)).select(first_match([], F.col("x") + 1).alias("y"))) == [(2,)]

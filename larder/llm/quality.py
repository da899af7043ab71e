"""Quality rules: a threshold table compiled into one projection."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.native import let

#: Words are maximal runs of other characters than these.
WORD = r"[^\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
#: Low bits of a sorted window's hash that hold its place.
_PLACE_BITS = 24
_PLACES = (1 << _PLACE_BITS) - 1

#: Frequent function words of the languages the rules are meant for.
STOP_WORDS = (
    *("the", "of", "and", "to", "in", "is", "that", "it", "for", "on", "with", "as", "was", "be", "by"),
    *("der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "ein", "auf", "im", "ist", "nicht"),
    *("de", "la", "le", "et", "les", "en", "un", "du", "que", "une", "pour", "est", "qui", "dans", "par"),
    *("el", "y", "los", "se", "del", "las", "por", "con", "no", "una", "su", "para", "al", "es", "lo"),
)


class Rule(NamedTuple):
    """``low * per <= count <= high * per``; a limit of None is not checked."""

    count: str
    per: str
    low: float | None
    high: float | None


#: A document is kept if all hold. The counts are those of ``measures``.
RULES = (
    Rule("n_words", "one", 50, None),
    Rule("n_repeat_words", "n_words", None, 0.5),
    Rule("word_chars", "n_words", 2.5, 10.0),
    Rule("n_symbols", "n_words", None, 0.1),
    Rule("n_shouts", "n_words", None, 0.3),
    Rule("n_stop_words", "n_words", 0.04, None),
    Rule("n_dup_lines", "n_lines", None, 0.5),
)
#: The rules that alone decide ``base_failed``.
BASE = RULES[:2]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _window_equal(w: Column, a: Column, b: Column) -> Column:
    return reduce(and_, (F.get(w, a + k) == F.get(w, b + k) for k in range(WINDOW)))


def _hash(w: Column, at: Column) -> Column:
    return F.xxhash64(*(F.get(w, at + k) for k in range(WINDOW)))


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(_PLACES)).cast("int")


def _repeats_by_hash(w: Column, s: Column) -> Column:
    """Places of windows equal to a neighbour in sorted ``s``: hash above, place below."""

    def equal(x: Column, y: Column) -> Column:
        near = F.shiftright(x.bitwiseXOR(y), _PLACE_BITS) == 0
        return F.coalesce(near, F.lit(False)) & _window_equal(w, _place(x), _place(y))

    marked = F.transform(s, lambda x, i: F.when(equal(x, F.get(s, i - 1)) | equal(x, F.get(s, i + 1)), _place(x)))
    return F.sort_array(F.filter(marked, lambda at: at.isNotNull()))


def _repeats_by_words(w: Column) -> Column:
    """The same from windows sorted as words, for texts in which hashes collide."""
    last = F.size(w) - WINDOW
    rows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(*(F.get(w, i + k).alias(f"w{k}") for k in range(WINDOW)), i.alias("at")),
    )

    def marks(s: Column) -> Column:
        def equal(x: Column, y: Column) -> Column:
            return F.coalesce(reduce(and_, (x[f"w{k}"] == y[f"w{k}"] for k in range(WINDOW))), F.lit(False))

        return F.transform(s, lambda x, i: F.when(equal(x, F.get(s, i - 1)) | equal(x, F.get(s, i + 1)), x["at"]))

    marked = let(F.sort_array(rows), marks)
    return F.sort_array(F.filter(marked, lambda at: at.isNotNull()))


def _repeated_places(w: Column) -> Column:
    """Places, in order, of the windows that occur more than once in an array of words."""
    last = F.size(w) - WINDOW
    packed = F.transform(
        F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
        lambda i: _hash(w, i).bitwiseAND(F.lit(~_PLACES)).bitwiseOR(i.cast("long")),
    )

    def places(s: Column) -> Column:
        # Neighbours with one hash but different words; then equal windows need not be neighbours.
        collides = F.exists(
            F.sequence(F.lit(1), F.size(s) - 1),
            lambda i: (F.shiftright(F.get(s, i).bitwiseXOR(F.get(s, i - 1)), _PLACE_BITS) == 0)
            & ~_window_equal(w, _place(F.get(s, i)), _place(F.get(s, i - 1))),
        )
        unsafe = (F.size(s) > _PLACES) | ((F.size(s) > 1) & collides)
        return F.when(unsafe, _repeats_by_words(w)).otherwise(_repeats_by_hash(w, s))

    return let(F.sort_array(packed), places)


def _counts(body: Column, w: Column, lines: Column) -> Column:
    covered = F.aggregate(
        _repeated_places(w),
        F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).cast("long").alias("n")),
        lambda done, at: F.struct(at.alias("at"), (done["n"] + F.least(F.lit(WINDOW), at - done["at"])).alias("n")),
        lambda done: done["n"],
    )
    counts = {
        "one": F.lit(1),
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.length(body) - _without(body, SYMBOLS),
        "n_shouts": F.length(body) - F.length(F.replace(body, F.lit("!"), F.lit(""))),
        "n_stop_words": F.size(F.filter(w, lambda word: F.lower(word).isin(*STOP_WORDS))),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": covered,
    }
    return F.struct(*(count.cast("long").alias(name) for name, count in counts.items()))


def measures(text: Column) -> Column:
    """All counts of a text, as a struct of longs.

    One expression, without shuffle or user function: three-word windows are
    sorted by hash within their document, so that equal ones are neighbours, and
    neighbours are compared word by word.
    """

    def counts(body: Column) -> Column:
        lines = F.filter(F.split(body, "\n"), lambda line: _without(line, _SPACES) > 0)
        return let(words(body), lambda w: let(lines, lambda own: _counts(body, w, own)))

    return let(F.coalesce(text, F.lit("")), counts)


def _holds(rule: Rule, counts: Column) -> Column:
    count, per = (counts[c].cast("double") for c in (rule.count, rule.per))
    checks = []
    if rule.low is not None:
        checks.append(count >= per * F.lit(float(rule.low)))
    if rule.high is not None:
        checks.append(count <= per * F.lit(float(rule.high)))
    return reduce(and_, checks)


def verdict(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``(counts, base_failed, kept)`` of a text: the threshold table as one expression.

    Null and empty texts have counts of zero and fail. A line counts as repeated
    if it holds a word and equals an earlier one.
    """

    def judged(counts: Column) -> Column:
        base, every = (reduce(and_, (_holds(rule, counts) for rule in table)) for table in (BASE, rules))
        return F.struct(counts.alias("counts"), (~base).alias("base_failed"), (base & every).alias("kept"))

    return let(measures(text), judged)


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(row, n_words, ..., base_failed, kept)`` for every row of ``docs``.

    ``row`` holds all columns of ``docs``. Repeated rows are judged alike.
    """
    judged = docs.select(F.struct("*").alias("row"), verdict(F.col(text), rules).alias("v"))
    return judged.select("row", "v.counts.*", "v.base_failed", "v.kept")


def passing(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that all rules keep, with their own columns."""
    return docs.where(verdict(F.col(text), rules)["kept"])


def _limits_sql(rule: Rule) -> str:
    checks = []
    if rule.low is not None:
        checks.append(f"{rule.count}::double >= {rule.per}::double * {float(rule.low)}::double")
    if rule.high is not None:
        checks.append(f"{rule.count}::double <= {rule.per}::double * {float(rule.high)}::double")
    return " and ".join(checks)


def oracle_sql(table: str = "documents") -> str:
    """The contract's columns, as DuckDB SQL over a table of documents."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    base = " and ".join(map(_limits_sql, BASE))
    every = " and ".join(map(_limits_sql, RULES))
    return f"""
with bodies as (
  select row_number() over () as id, doc_id, coalesce(text, '') as body,
    regexp_extract_all(coalesce(text, ''), '{WORD}') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda line: length(translate(line, {spaces}, '')) > 0) as lines
  from {table}),
grams as (
  select id, pos, words[pos] as a, words[pos + 1] as b, words[pos + 2] as c
  from (select id, words, unnest(range(1, len(words) - 1)) as pos from bodies)),
again as (
  select id, pos from (select id, pos, count(*) over (partition by id, a, b, c) as n from grams) where n > 1),
covered as (
  select id, count(distinct pos + k) as n from again, (values (0), (1), (2)) steps(k) group by id),
counted as (
  select b.doc_id, 1 as one, len(words)::bigint as n_words,
    length(translate(body, {spaces}, ''))::bigint as word_chars,
    (length(body) - length(translate(body, '{SYMBOLS}', '')))::bigint as n_symbols,
    (length(body) - length(translate(body, '!', '')))::bigint as n_shouts,
    len(list_filter(words, lambda word: lower(word) in ({stop}))) as n_stop_words,
    len(lines) as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(c.n, 0)::bigint as n_repeat_words
  from bodies b left join covered c using (id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  not ({base}) as base_failed, ({base}) and ({every}) as kept
from counted"""

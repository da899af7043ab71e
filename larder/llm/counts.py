"""Token counts by a compiled finite-state tokenizer."""

from __future__ import annotations

import json
import unicodedata
from functools import cache, reduce

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larder.llm.pieces import Cache, chunks, text_of
from larder.llm.transducer import WORD_END, Automaton
from larder.sources import stage

CHUNK = 1 << 16
#: Neighbouring maps that are composed in one step.
FAN = 16
_SUFFIX = "</w>"
_MARKS = (".", ",", ";", ":", "!", "?")
_WHITE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Python splits at these, Unicode does not count them as whitespace.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def split_words(text: str) -> list[str]:
    """The maximal runs without Unicode whitespace."""
    if any(c in text for c in _SEPARATORS):
        return [word for word in _WHITE.split(text) if word]
    return text.split()


@cache
def _byte_of() -> dict[str, int]:
    """The byte behind each printable stand-in of a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """A word-level BPE file, compiled to count tokens deterministically.

    Words are runs of letters, single digits, or runs of other characters. Within a word the
    transitions of ``Automaton`` carry the counts, compiled from the file's merges;
    a word's end leads back to the start state. Counts of whole words are kept
    in a bounded table.

    Raises ValueError for files of another kind.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        kinds = [n["type"] for n in parts["normalizer"]["normalizers"]]
        split, level = parts["pre_tokenizer"]["pretokenizers"]
        known = (
            model["type"] == "BPE"
            and model["end_of_word_suffix"] == _SUFFIX
            and kinds == ["NFC", "Replace", "Lowercase"]
            and (split["type"], split["behavior"], split["invert"]) == ("Split", "Removed", True)
            and (level["type"], level["use_regex"]) == ("ByteLevel", False)
        )
        if not known:
            raise ValueError(f"{path} is not a word-level BPE file with word ends")
        self.word = regex.compile(split["pattern"]["Regex"])
        special = "|".join(regex.escape(t["content"]) for t in parts["added_tokens"])
        self.special = regex.compile(f"({special})")
        self.automaton = Automaton([(self._raw(a), self._raw(b)) for a, b in model["merges"]])
        self.agreed: dict[str, bool] = {}
        self.counts = Cache(self._count)

    @staticmethod
    def _raw(token: str) -> bytes:
        end = token.endswith(_SUFFIX)
        byte_of = _byte_of()
        return bytes(byte_of[c] for c in (token.removesuffix(_SUFFIX) if end else token)) + WORD_END * end

    @staticmethod
    def _normal(text: str) -> str:
        # lower() alone would make a final sigma, which depends on the neighbours.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _agrees(self, char: str) -> bool:
        """Whether the library splits this character as this class does."""
        if char not in self.agreed:
            to_char = {b: c for c, b in _byte_of().items()}
            self.agreed[char] = all(
                [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(probe))]
                == ["".join(to_char[b] for b in w.encode()) for u in split_words(probe) for w in self.word.findall(self._normal(u))]
                for probe in (f"x{char}x", f"!{char}!", f"1{char}1")
            )
        return self.agreed[char]

    def _word(self, word: str) -> int:
        return self.automaton.count(word.encode())

    def _count(self, unit: str) -> int:
        """Tokens of text without whitespace."""
        if unit.isascii():
            if unit.isalpha():
                return self._word(unit.lower())
            core = unit[:-1]
            if unit.endswith(_MARKS) and core.isalpha():
                return self.counts[core] + self._word(unit[-1])
            if "<" not in unit:
                return sum(map(self._word, self.word.findall(unit.lower())))
        if not all(map(self._agrees, set(unit))):
            return len(self.library.encode(unit, add_special_tokens=False))
        total = 0
        for i, part in enumerate(self.special.split(unit)):
            total += 1 if i % 2 else sum(map(self._word, self.word.findall(self._normal(part))))
        return total

    def count(self, text: str) -> int:
        """Annotations along the path of a whole text."""
        return sum(map(self.counts.__getitem__, split_words(text)))

    def state_map(self, part: str) -> tuple[bool, str, int, str]:
        """What a part of a text does to any state: ``(finishes, head, count, tail)``.

        From state s a part that finishes a word leads to ``tail`` and emits the
        tokens of s + head, then ``count``. One without whitespace leads to s + head.
        """
        words = split_words(part)
        starts, ends = (bool(_WHITE.match(c)) for c in (part[:1], part[-1:]))
        if len(words) == 1 and not starts and not ends:
            return False, part, 0, ""
        if not part:
            return False, "", 0, ""
        head = "" if starts else words[0]
        tail = "" if ends else words[-1]
        inner = words[len(words[:1]) * (not starts) : len(words) - (not ends)]
        return True, head, sum(map(self.counts.__getitem__, inner)), tail

    def compose(self, first: tuple, then: tuple) -> tuple:
        """The state map of two neighbouring parts."""
        finishes, head, count, tail = first
        finishes_then, head_then, count_then, tail_then = then
        if not finishes:
            return finishes_then, head + head_then, count_then, tail_then
        if not finishes_then:
            return True, head, count, tail + head_then
        return True, head, count + self.counts[tail + head_then] + count_then, tail_then

    def total(self, whole: tuple) -> int:
        """Tokens of a text, given its map."""
        _, head, count, tail = whole
        return self.counts[head] + count + self.counts[tail]


@cache
def transducer(path: str) -> Transducer:
    return Transducer(path)


def _count_long(long_docs: DataFrame, path: str, chunk: int) -> DataFrame:
    """``(doc, n_bytes, n_tokens)`` of texts in chunks: map all, compose neighbours level by level."""

    def as_maps(maps: list[tuple]) -> pa.Array:
        kinds = (pa.bool_(), pa.string(), pa.int64(), pa.string())
        columns = [pa.array([m[i] for m in maps], kind) for i, kind in enumerate(kinds)]
        return pa.StructArray.from_arrays(columns, ["finishes", "head", "count", "tail"])

    @F.arrow_udf("finishes boolean, head string, count long, tail string")
    def map_part(parts: pa.Array) -> pa.Array:
        return as_maps([transducer(path).state_map(text_of(part)) for part in parts])

    @F.arrow_udf("finishes boolean, head string, count long, tail string")
    def compose_some(rows: pa.Array) -> pa.Array:
        own = transducer(path)
        return as_maps([reduce(own.compose, (tuple(m.values()) for m in row)) for row in rows.to_pylist()])

    @F.arrow_udf("long")
    def total(maps: pa.Array) -> pa.Array:
        own = transducer(path)
        return pa.array([own.total(tuple(m.values())) for m in maps.to_pylist()], pa.int64())

    rows = long_docs.withColumn("uid", F.monotonically_increasing_id())
    parts = stage(chunks(rows, chunk), "chunks")
    most = parts.agg(F.max("idx")).first()[0]
    dealt = parts.repartition("uid", "idx")
    maps = dealt.select("uid", "doc", "n_bytes", "idx", map_part("part").alias("map"))
    level = most or 0
    while level:  # the up-sweep of a parallel scan: a step composes few neighbours, whatever the text's length
        up = F.floor(F.col("idx") / FAN).cast("int").alias("idx")
        in_order = F.array_sort(F.collect_list(F.struct("idx", "map")))["map"]
        some = maps.groupBy("uid", up).agg(F.first("doc").alias("doc"), F.first("n_bytes").alias("n_bytes"), in_order.alias("maps"))
        maps = some.select("uid", "doc", "n_bytes", "idx", compose_some("maps").alias("map"))
        level //= FAN
    return maps.select("doc", "n_bytes", total("map").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """``(key, n_bytes, n_tokens)`` of every row: UTF-8 bytes and tokens of its whole text.

    ``path`` is a word-level BPE file that every executor can open. Texts above
    ``chunk`` bytes are cut anywhere into parts; each part's state map is
    computed in parallel, and ``FAN`` neighbouring maps are composed at a time, level by level.
    The composition is associative, so where a text is cut does not matter. Shorter
    texts are one part and need no shuffle.

    Counts equal the library's without added special tokens; special strings in
    a text count as one token. Words with characters that the library classes
    otherwise than this compiler go to the library. Null and empty texts have no
    tokens; invalid UTF-8 is read as U+FFFD. Rows with the same key stay separate.
    Other columns are not read.
    """

    @F.arrow_udf("long")
    def count_short(texts: pa.Array) -> pa.Array:
        own = transducer(path)
        return pa.array([own.count(text_of(text)) for text in texts], pa.int64())

    read = docs.select(F.col(key).alias("doc"), F.col(text).cast("binary").alias("text"))
    is_long = F.coalesce(F.octet_length("text") > chunk, F.lit(False))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    short = read.where(~is_long).select("doc", n_bytes, count_short("text").alias("n_tokens"))
    return short.unionByName(_count_long(read.where(is_long), path, chunk)).withColumnRenamed("doc", key)

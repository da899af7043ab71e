"""Fill-in-the-middle examples by secondary-sort assembly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
#: Per cent of texts that are transformed, and of these the ones with the suffix first.
FIM_PERCENT, SPM_PERCENT = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: A piece holds at most so many units, and bytes.
PIECE_UNITS, PIECE_BYTES = 4096, 1 << 16
_FLUSH_BYTES, _FLUSH_ROWS = 4 << 20, 2000
#: The parts of a text in the order of each form: 0 is the prefix, 1 the middle, 2 the suffix.
_ORDERS = {"plain": (), "psm": (0, 2, 1), "spm": (2, 0, 1)}
_MARKS = (PREFIX, MIDDLE, SUFFIX)
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_FACTS = "n long, form string, prefix_chars long, middle_chars long"


def unit_ends(text: bytes) -> np.ndarray:
    """Where each unit ends: a word with the whitespace before it, or whitespace at the end of the text."""
    if not text:
        return np.zeros(0, np.int64)
    white = _WHITE[np.frombuffer(text, np.uint8)]
    return np.append(np.flatnonzero(~white[:-1] & white[1:]) + 1, len(text))


def _characters(text: bytes) -> int:
    """Code points: bytes that do not continue one."""
    return int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 != 0x80))


class Cut:
    """How a text is cut, by four random 32-bit numbers."""

    def __init__(self, text: bytes, draws: tuple[int, int, int, int], fim_percent: int, spm_percent: int):
        self.text, self.ends = text, unit_ends(text)
        self.n = len(self.ends)
        first, last = sorted((draws[0] % (self.n + 1), draws[1] % (self.n + 1)))
        plain = not text or draws[2] % 100 >= fim_percent or any(mark in text for mark in _MARKS)
        self.form = "plain" if plain else "spm" if draws[3] % 100 < spm_percent else "psm"
        places = [0, *(int(self.ends[k - 1]) if k else 0 for k in (first, last)), len(text)]
        self.parts = list(pairwise(places))

    def facts(self) -> tuple:
        if self.form == "plain":
            return self.n, self.form, None, None
        prefix, middle = (_characters(self.text[a:b]) for a, b in self.parts[:2])
        return self.n, self.form, prefix, middle

    def _bounds(self, start: int, end: int) -> Iterator[tuple[int, int]]:
        """Pieces of whole units; one is cut inside only where it is longer than a piece."""
        inside = self.ends[np.searchsorted(self.ends, start, "right") : np.searchsorted(self.ends, end)]
        for a, b in pairwise([start, *inside[PIECE_UNITS - 1 :: PIECE_UNITS].tolist(), end]):
            for at in range(a, max(b, a + 1), PIECE_BYTES):
                yield at, min(b, at + PIECE_BYTES)

    def pieces(self) -> Iterator[bytes]:
        """The output's pieces in order; a part's first piece starts with its mark."""
        if self.form == "plain":
            yield from (self.text[a:b] for a, b in self._bounds(0, len(self.text)))
            return
        for part in _ORDERS[self.form]:
            mark = _MARKS[part]
            for a, b in self._bounds(*self.parts[part]):
                yield mark + self.text[a:b]
                mark = b""


class Reader:
    """Finds the parts again in the pieces of an output, with two bytes held back at most; a plain one is one part."""

    def __init__(self, form: str):
        self.coming = list(_ORDERS[form])
        self.part, self.held = 0, b""

    def feed(self, piece: bytes) -> Iterator[tuple[int, bytes]]:
        self.held += piece
        while self.coming:
            mark = _MARKS[self.coming[0]]
            at = self.held.find(mark)
            if at < 0:
                break
            if at:
                yield self.part, self.held[:at]
            self.held = self.held[at + len(mark) :]
            self.part = self.coming.pop(0)
        keep = len(PREFIX) - 1 if self.coming else 0
        if len(self.held) > keep:
            yield self.part, self.held[: len(self.held) - keep]
            self.held = self.held[len(self.held) - keep :]


class _Rows:
    """Rows gathered into Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, *row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += sum(len(x) for x in row if isinstance(x, bytes))
        if len(self.rows) >= _FLUSH_ROWS or self.size >= _FLUSH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.size = [], 0


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _arrow_schema(df: DataFrame, ddl: str) -> tuple[str, pa.Schema]:
    """DDL and Arrow schema of ``row, doc`` and further columns, where ``doc`` is typed as in ``df``."""
    kind = df.schema["doc"].dataType.simpleString()
    names = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    more = [tuple(field.split()) for field in ddl.split(", ")]
    doc = pa.field("doc", df.select("doc").limit(0).toArrow().schema.field("doc").type)
    fields = [pa.field("row", pa.int64()), doc, *(pa.field(name, names[t]) for name, t in more)]
    return f"row long, doc {kind}, {ddl}", pa.schema(fields)


def _read(docs: DataFrame, key: str, text: str, seed: int) -> DataFrame:
    """``(row, doc, text, draws)``: ``row`` tells rows with the same key apart."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("doc"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"),
        F.unhex(F.substring(F.sha2(name, 256), 1, 32)).alias("draws"),
    )


def pieces(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """The outputs as pieces, each document's in one partition and in order.

    Rows ``(row, doc, n, form, prefix_chars, middle_chars, at, piece)``: unit chunks,
    keyed by document and output position, are dealt by document and sorted inside the
    partitions (``repartitionAndSortWithinPartitions`` in frames), so that what follows
    streams through each document in order, whatever its length. ``row`` numbers the
    rows of ``docs``; equal keys stay apart. A document has one piece at least.
    """
    read = _read(docs, key, text, seed)
    ddl, schema = _arrow_schema(read, f"{_FACTS}, at int, piece binary")

    def emit(batches):
        out = _Rows(schema)
        for row, doc, body, drawn in _rows_of(batches):
            draws = tuple(int.from_bytes(drawn[i : i + 4], "big") for i in range(0, 16, 4))
            cut = Cut(body, draws, fim_percent, spm_percent)
            facts = cut.facts()
            for at, piece in enumerate(cut.pieces()):
                yield from out.add(row, doc, *facts, at, piece)
        yield from out.flush()

    return read.mapInArrow(emit, ddl).repartition("row").sortWithinPartitions("row", "at")


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``(key, n, form, prefix_chars, middle_chars, output)`` of every row of ``docs``.

    A text is cut into ``n`` units (a word with the whitespace before it, or whitespace
    at the end), and at two random places among them. Form ``psm`` gives prefix, suffix and
    middle, ``spm`` suffix, prefix and middle, each behind its mark; ``plain`` is the text.
    Random numbers come from the seed and the key alone, so reruns agree and rows with
    one key are cut by the same numbers. A null key counts as an empty one, a null text as
    empty; empty texts and those that hold a mark are plain. Repeated rows stay separate,
    other columns are not read. The rows of ``docs`` must come in the same order when a task
    is rerun, as those of files do.
    """
    sorted_pieces = pieces(docs, key, text, **options)
    ddl, schema = _arrow_schema(sorted_pieces, f"{_FACTS}, output string")

    def gather(batches):
        out = _Rows(schema)
        for _, rows in groupby(_rows_of(batches), itemgetter(0)):
            first = next(rows)
            body = b"".join([first[-1], *(r[-1] for r in rows)])
            yield from out.add(*first[:6], body.decode("utf-8", "replace"))
        yield from out.flush()

    return sorted_pieces.mapInArrow(gather, ddl).drop("row").withColumnRenamed("doc", key)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``(key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)`` of every row.

    As ``transform``, without ever holding an output: the sorted pieces run into an
    incremental digest, and into a reader that finds the marks in the stream and passes the
    parts on, keyed by their place in the text. A second sort inside the same partitions,
    without a shuffle, restores the text's order for a second digest. Lower-case hex.
    """
    sorted_pieces = pieces(docs, key, text, **options)
    ddl, schema = _arrow_schema(sorted_pieces, f"{_FACTS}, output_sha256 binary, part int, at int, piece binary")
    done_ddl, done_schema = _arrow_schema(sorted_pieces, f"{_FACTS}, output_sha256 string, restored_sha256 string")

    def take_apart(batches):
        out = _Rows(schema)
        for _, rows in groupby(_rows_of(batches), itemgetter(0)):
            digest, reader, at = hashlib.sha256(), None, 0
            for row, doc, n, form, prefix_chars, middle_chars, _, piece in rows:
                facts = (row, doc, n, form, prefix_chars, middle_chars)
                reader = reader or Reader(form)
                digest.update(piece)
                for part, own in reader.feed(piece):
                    yield from out.add(*facts, None, part, at, own)
                    at += 1
            yield from out.add(*facts, digest.digest(), -1, 0, b"")
        yield from out.flush()

    def put_together(batches):
        out = _Rows(done_schema)
        for _, rows in groupby(_rows_of(batches), itemgetter(0)):
            head = next(rows)
            digest = hashlib.sha256()
            for row in rows:
                digest.update(row[-1])
            yield from out.add(*head[:6], head[6].hex(), digest.hexdigest())
        yield from out.flush()

    parts = sorted_pieces.mapInArrow(take_apart, ddl).sortWithinPartitions("row", "part", "at")
    return parts.mapInArrow(put_together, done_ddl).drop("row").withColumnRenamed("doc", key)


def restore(output: Column, form: Column) -> Column:
    """The text behind an output, from the output and its form alone."""

    def between(first: bytes, last: bytes | None = None) -> Column:
        rest = F.substring_index(output, first.decode(), -1)
        return F.substring_index(rest, last.decode(), 1) if last else rest

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def oracle_sql() -> str:
    """DuckDB SQL of ``digests`` over ``documents``."""
    unit = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
    draws = ", ".join(f"('0x' || substr(h, {8 * i + 1}, 8))::ubigint as h{i + 1}" for i in range(4))
    marked = " or ".join(f"contains(body, '{mark.decode()}')" for mark in _MARKS)
    return f"""
with read as (
  select doc_id, coalesce(text, '') as body, sha256('{SEED}:' || coalesce(doc_id::varchar, '')) as h from documents
), units as (
  select *, regexp_extract_all(body, '{unit}') as units, {draws} from read
), placed as (
  select *, len(units) as n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as first,
    greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as last,
    case when body = '' or {marked} or h3 % 100 >= {FIM_PERCENT} then 'plain'
      when h4 % 100 < {SPM_PERCENT} then 'spm' else 'psm' end as form
  from units
), parts as (
  select *, array_to_string(units[1:first], '') as prefix, array_to_string(units[first + 1:last], '') as middle,
    array_to_string(units[last + 1:], '') as suffix from placed
)
select doc_id, n::bigint as n, form,
  case when form <> 'plain' then length(prefix) end as prefix_chars,
  case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then body when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(body) as restored_sha256
from parts"""

"""Removal of repeated byte strings by longest previous factors in suffix order."""

from __future__ import annotations

from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.sources import stage, unstage

LENGTH = 400
#: Bytes of the strings that anchor windows, at most; of a block that is hashed at a time.
GRAM, BLOCK = 64, 1 << 19
#: Contexts with one anchor that a task takes together, and bytes of a suffix array.
GROUP, ARRAY = 512, 1 << 20

#: Windows per range, from level to level, where an anchor has more contexts.
_RANGE_SIZES = (64, 16, 4, 1)

_POSITION = 20  # bits of a place within a block and the windows behind it
_U = np.uint64


@cache
def _powers(stream: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value per byte, and the powers of an odd base and of its inverse."""
    draw = np.random.Generator(np.random.Philox(key=[400, stream])).integers(0, 1 << 63, 257, dtype=np.uint64)
    values, base = draw[:256], int(draw[256]) * 2 + 1 & (1 << 64) - 1
    size = 1 << _POSITION

    def powers(x: int) -> np.ndarray:
        steps = np.full(size, x, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return values, powers(base), powers(pow(base, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> _U(30)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> _U(27)) * _U(0x94D049BB133111EB)
    return x ^ x >> _U(31)


class _Hashes:
    """Polynomial hashes of any substring of a block of bytes."""

    def __init__(self, block: np.ndarray, stream: int):
        values, self.powers, self.inverse = _powers(stream)
        self.sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(values[block] * self.powers[: len(block)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(-1, width)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def _blocks(texts: list[bytes], length: int):
    """``(joined bytes, [(row, offset, place, windows)])``: bounded blocks of whole or cut texts."""
    parts, size = [], 0
    for row, text in enumerate(texts):
        for offset in range(0, len(text) - length + 1, BLOCK):
            piece = text[offset : offset + BLOCK + length - 1]
            if size + len(piece) > BLOCK + length - 1 and parts:
                yield parts
                parts, size = [], 0
            parts.append((row, offset, piece))
            size += len(piece)
    if parts:
        yield parts


def _anchored(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Runs of windows with one anchor: ``(row, lo, hi, gap, anchor, k1, k2)``, as columns.

    The anchor's place is ``lo + gap``; ``k1`` and ``k2`` name all bytes of the run.

    A window is a string of ``length`` bytes, named by its start. Its anchor is the
    place in it whose short string hashes lowest, the leftmost of equals. Equal
    windows so have equal anchors, at equal distance.
    """
    gram = min(GRAM, length)
    found = []
    for parts in _blocks(texts, length):
        block = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
        first, second = _Hashes(block, 1), _Hashes(block, 2)
        places = np.arange(len(block) - gram + 1)
        grams = first.of(places, places + gram)
        low = (grams >> _U(_POSITION) << _U(_POSITION)) | places.astype(np.uint64)
        anchors = (_least(low, length - gram + 1) & _U((1 << _POSITION) - 1)).astype(np.int64)
        begins = np.cumsum([0, *(len(p[2]) for p in parts)])
        for (row, offset, piece), begin in zip(parts, begins[:-1], strict=True):
            own = anchors[begin : begin + len(piece) - length + 1]
            lo = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1))
            hi = np.concatenate((lo[1:] - 1, [len(own) - 1]))
            at = own[lo]
            starts, ends = begin + lo, begin + hi + length
            shift = _mix(((at - starts) << 32 | (hi - lo)).astype(np.uint64))
            k1, k2 = first.of(starts, ends) ^ shift, second.of(starts, ends) ^ shift
            rows = np.full(len(lo), row)
            found.append((rows, offset + lo, offset + hi, at - starts, grams[at].view(np.int64), k1.view(np.int64), k2.view(np.int64)))
    if not found:
        return [np.zeros(0, np.int64)] * 7
    return [np.concatenate(column) for column in zip(*found, strict=True)]


def _refined(ranks: np.ndarray, n: int, step: int) -> np.ndarray:
    """Ranks by twice, or ``step`` more, of the compared bytes; only ties are sorted again."""
    tied = np.flatnonzero((np.bincount(ranks[:n], minlength=n) > 1)[ranks[:n]])
    following = ranks.copy()
    if len(tied):
        old = ranks[tied]
        keys = old * (n + 1) + ranks[tied + step] + 1
        order = np.argsort(keys, kind="stable")
        old, keys = old[order], keys[order]
        at = np.arange(len(order))
        group = np.maximum.accumulate(np.where(np.concatenate(([True], old[1:] != old[:-1])), at, 0))
        part = np.maximum.accumulate(np.where(np.concatenate(([True], keys[1:] != keys[:-1])), at, 0))
        following[tied[order]] = old + part - group
    return following


def suffix_order(text: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their suffixes, and how many bytes each shares with the one before it.

    Suffixes are cut at ``length`` bytes, of which each of the ascending places has as many; equal
    ones are in the order of their places. Ranks by 8 bytes are refined by doubling, and
    the ranks of all steps give the shared lengths.
    """
    n = len(text)
    padded = np.zeros(n + length + 8, np.uint64)
    padded[:n] = text
    packed = np.zeros(n + length, np.uint64)
    for k in range(8):
        packed = packed << _U(8) | padded[k : k + n + length]
    if length < 8:
        packed = packed >> _U(64 - 8 * length) << _U(64 - 8 * length)
    first = np.argsort(packed[:n], kind="stable")
    new = np.concatenate(([True], packed[first[1:]] != packed[first[:-1]]))
    ranks = np.full(n + length, -1, np.int64)
    ranks[first] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    steps, done = [(8, ranks)], 8
    while done < length:
        step = min(done, length - done)
        ranks = _refined(ranks, n, step)
        done += step
        if done < length:
            steps.append((done, ranks))
    order = places[np.argsort(ranks[places], kind="stable")]
    shared = np.zeros(len(order), np.int64)
    a, b = order[:-1], order[1:]
    same = ranks[a] == ranks[b]
    shared[1:][same] = length
    differ = np.flatnonzero(~same)
    a, b, long = a[differ], b[differ], np.zeros(len(differ), np.int64)
    for size, own in reversed(steps):
        long += size * (own[a + long] == own[b + long])
    rest = packed[a + long] ^ packed[b + long]
    long += sum((rest >> _U(64 - 8 * k) == 0).astype(np.int64) for k in range(1, 8))
    shared[differ + 1] = np.minimum(long, length)
    return order, shared


def _nearest_smaller(values: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest smaller value before each, or -1, and the least of ``shared`` on the way there."""
    n = len(values)
    least, common = [values], [shared]
    while 1 << len(least) < n:
        size = 1 << len(least) - 1
        least.append(np.concatenate((least[-1][:size], np.minimum(least[-1][size:], least[-1][:-size]))))
        common.append(np.concatenate((common[-1][:size], np.minimum(common[-1][size:], common[-1][:-size]))))
    at, low = np.arange(n) - 1, shared.copy()
    for level in reversed(range(len(least))):
        size = 1 << level
        far = np.flatnonzero(at >= size - 1)
        far = far[least[level][at[far]] > values[far]]
        low[far] = np.minimum(low[far], common[level][at[far]])
        at[far] -= size
    return at, np.where(at >= 0, low, 0)


def previous_factors(order: np.ndarray, shared: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of a suffix order the length of its longest previous factor, and where that is.

    The longest string that starts at a place and also at an earlier one starts at
    the previous or the next smaller place in suffix order; the lengths shared on the way there say
    how long it is. Factors shorter than ``least`` count as none: length 0, place -1.
    """
    near = shared >= least
    inside = np.flatnonzero(near | np.concatenate((near[1:], [False])))
    places, common = order[inside], np.where(near, shared, 0)[inside]
    lengths, sources = np.zeros(len(order), np.int64), np.full(len(order), -1, np.int64)
    if len(inside):
        before, long = _nearest_smaller(places, common)
        back, long_after = _nearest_smaller(places[::-1], np.concatenate(([0], common[:0:-1])))
        after, long_after = len(places) - 1 - back[::-1], long_after[::-1]
        source = np.where(long >= long_after, before, np.minimum(after, len(places) - 1))
        best = np.maximum(long, long_after)
        lengths[inside] = best
        sources[inside] = np.where(best > 0, places[source], -1)
    return lengths, sources


def _ranges(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [{"from": int(a), "to": int(b) - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)]


_RANGES = "array<struct<from: int, to: int>>"
_ARROW_RANGES = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
_CLASS, _PLACE = ("anchor", "k1", "k2"), ("d1", "d2", "lo")


def _by_suffix_array(contexts: DataFrame, length: int) -> DataFrame:
    """``(d1, d2, lo, earlier, any)``: which windows of a context occur in others of its anchor."""

    def flush(group: list[tuple]):
        text = np.frombuffer(b"".join(row[-1] for row in group), np.uint8)
        begins = np.cumsum([0, *(len(row[-1]) for row in group)])
        counts = np.diff(begins) - length + 1
        places = np.concatenate([np.arange(b, b + n) for b, n in zip(begins, counts, strict=False)])
        order, shared = suffix_order(text, places, length)
        at = np.searchsorted(places, order)
        earlier, repeated = np.zeros(len(places), bool), np.zeros(len(places), bool)
        earlier[at] = previous_factors(order, shared, length)[0] >= length
        repeated[at] = (shared >= length) | np.concatenate((shared[1:] >= length, [False]))
        cuts = np.cumsum(counts)[:-1]
        columns = [pa.array([row[i] for row in group], pa.int64()) for i in range(3, 6)]
        for flags in (earlier, repeated):
            columns.append(pa.array([_ranges(f) for f in np.split(flags, cuts)], _ARROW_RANGES))
        return pa.RecordBatch.from_arrays(columns, [*_PLACE, "earlier", "any"])

    def work(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in (*_CLASS, *_PLACE, "bytes")), strict=True)

        group, size = [], 0
        for _, same in groupby(rows(), key=lambda row: row[0]):
            if size >= ARRAY:
                yield flush(group)
                group, size = [], 0
            seen = set()
            for row in same:
                if row[1:3] not in seen:  # rows that are repeated in the input
                    seen.add(row[1:3])
                    group.append(row)
                    size += len(row[-1])
        if group:
            yield flush(group)

    ordered = contexts.repartition("anchor").sortWithinPartitions("anchor", "doc", "d1", "d2", "lo")
    schema = f"d1 long, d2 long, lo long, earlier {_RANGES}, any {_RANGES}"
    return ordered.select(*_CLASS, *_PLACE, "bytes").mapInArrow(work, schema)


def _slice(start: Column, end: Column) -> Column:
    return F.substring("bytes", (start + 1).cast("int"), (end - start).cast("int"))


def _by_halving(contexts: DataFrame, length: int) -> DataFrame:
    """The same, one row per range, for anchors with many contexts: without gathering any.

    Ranges of windows, by distance from the anchor, are compared as wholes. What all
    windows of a range share is its core, all their bytes are its hull. Contexts
    with equal hulls repeat each other in the whole range. Contexts
    whose core no other has share no window of it. Of each hull one context goes on to
    the next smaller ranges, if other hulls have the same core.
    """
    names = ("range", "c1", "c2", "h1", "h2", "near", "far")
    rows = contexts.select("anchor", "doc", *_PLACE, "hi", "gap", "bytes").dropDuplicates([*_PLACE, "hi"])
    sizes = [size for size in _RANGE_SIZES if size < length]
    spread = F.sequence(F.floor((F.col("gap") - F.col("hi") + F.col("lo")) / sizes[0]), F.floor(F.col("gap") / sizes[0]))
    rows = stage(rows.withColumn("range", F.explode(spread)), "ranges")
    found = rows.select(*_PLACE, F.lit(True).alias("later"), F.col("lo").alias("from"), F.col("lo").alias("to")).limit(0)
    for size, smaller in zip(sizes, [*sizes[1:], None], strict=True):
        if rows.isEmpty():
            break
        first, gap = F.col("range") * size, F.col("gap")
        core = _slice(gap - first, gap - first - (size - 1) + length)
        hull = _slice(gap - F.col("far"), gap - F.col("near") + length)
        keyed = rows.withColumns(
            {
                "near": F.greatest(first, gap - F.col("hi") + F.col("lo")),
                "far": F.least(first + (size - 1), gap),
            }
        ).withColumns(
            {
                "c1": F.xxhash64(core),
                "c2": F.xxhash64(F.lit("core"), core),
                "h1": F.xxhash64(hull),
                "h2": F.xxhash64(F.lit("hull"), hull),
                "place": F.struct("doc", *_PLACE),
            }
        )
        keyed = stage(keyed, "ranges")
        hulls = stage(keyed.groupBy("anchor", *names).agg(F.count("*").alias("n"), F.min("place").alias("least")), "hulls")
        cores = hulls.groupBy("anchor", *names[:3]).agg(F.count("*").alias("others")).where("others > 1")
        cores = stage(cores.withColumn("open", F.lit(True)).drop("others"), "cores")
        known = stage(hulls.join(cores, ["anchor", *names[:3]], "left").where("n > 1 or open"), "known")
        done = stage(keyed.join(known, ["anchor", *names]), "ranges")
        is_first = F.col("place").eqNullSafe(F.col("least"))
        found = found.unionByName(
            done.where("n > 1").select(*_PLACE, (~is_first).alias("later"), (gap - F.col("far")).alias("from"), (gap - F.col("near")).alias("to"))
        )
        if smaller:
            parts = F.sequence(F.col("range") * (size // smaller), F.col("range") * (size // smaller) + (size // smaller - 1))
            going = done.where(F.col("open") & is_first).select("anchor", "doc", *_PLACE, "hi", "gap", "bytes", F.explode(parts).alias("range"))
            first = F.col("range") * smaller
            within = (first <= gap) & (first + (smaller - 1) >= gap - F.col("hi") + F.col("lo"))
            rows = stage(going.where(within), "ranges")
    one = F.struct(F.col("from").cast("int").alias("from"), F.col("to").cast("int").alias("to"))
    return found.groupBy(*_PLACE).agg(
        F.collect_set(F.when(F.col("later"), one)).alias("earlier"), F.collect_set(one).alias("any")
    )


def _identity(key: str, text: str) -> list[Column]:
    """128 bits that name a row by its key and text, null or not."""
    a, b = F.col(key), F.col(text)
    return [F.xxhash64(a, b).alias("d1"), F.xxhash64(b, F.lit("row"), a).alias("d2")]


def repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, keep: str = "first"
) -> DataFrame:
    """``(d1, d2, start, end)``: bytes of each document that lie in repeated strings.

    A string is repeated where its ``length`` bytes also start elsewhere, in any
    document or the same one: earlier (``keep="first"``: by key, then place),
    or anywhere (``keep="none"``).

    All windows of a text are dealt to anchors. Contexts of an anchor, the
    bytes of its run of windows, are compared as wholes by their 128-bit hash, which settles
    all but the ends of repetitions. Where an anchor has different contexts, one of
    each goes to a suffix array, in which longest previous factors are cut at
    ``length``. An anchor with more than ``GROUP`` contexts is not gathered: ranges
    of its windows are compared by hash, and only their ends more finely.
    """
    if keep not in ("first", "none"):
        raise ValueError("keep must be 'first' or 'none'")
    kind = docs.schema[key].dataType.simpleString()
    arrow_kind = docs.select(key).limit(0).toArrow().schema.field(0).type

    def anchored(batches):
        for batch in batches:
            texts = [(t.as_py() or b"") for t in batch.column("text")]
            rows, *numbers = _anchored(texts, length)
            names = [batch.column(c).take(pa.array(rows)) for c in ("doc", "d1", "d2")]
            columns = [pa.array(x, pa.int64()) for x in numbers]
            yield pa.RecordBatch.from_arrays(
                [names[0].cast(arrow_kind), *names[1:], *columns], ["doc", "d1", "d2", "lo", "hi", "gap", *_CLASS]
            )

    read = docs.select(F.col(key).alias("doc"), *_identity(key, text), F.col(text).cast("binary").alias("text"))
    runs = stage(
        read.where(F.octet_length("text") >= length).mapInArrow(
            anchored, f"doc {kind}, d1 long, d2 long, lo long, hi long, gap long, anchor long, k1 long, k2 long"
        ),
        "runs",
    )
    # Most anchors occur once, and what has them repeats nothing.
    met = runs.groupBy("anchor").agg(F.count("*").alias("runs")).where("runs > 1")
    met = stage(runs.join(stage(met.select("anchor"), "met"), "anchor"), "met-runs")
    unstage(runs)
    place = F.struct("doc", "d1", "d2", "lo", "hi", "gap")
    classes = met.groupBy(*_CLASS).agg(F.count("*").alias("n"), F.min(place).alias("first"))
    classes = stage(classes, "classes")
    several = classes.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1")
    examples = classes.join(stage(several, "several"), "anchor").select(*_CLASS, "m", "first.*")
    wanted = examples.groupBy("d1", "d2").agg(F.collect_list(F.struct(*_CLASS, "m", "lo", "hi", "gap")).alias("wanted"))
    cut = read.join(wanted, ["d1", "d2"]).select("doc", "d1", "d2", "text", F.explode("wanted").alias("w"))
    taken = F.substring("text", (F.col("w.lo") + 1).cast("int"), (F.col("w.hi") - F.col("w.lo") + length).cast("int"))
    contexts = stage(cut.select("doc", "d1", "d2", "w.*", taken.alias("bytes")), "contexts")
    small = _by_suffix_array(contexts.where(F.col("m") <= GROUP), length)
    large = _by_halving(contexts.where(F.col("m") > GROUP), length)
    # What a context shares with others holds for its first place; its copies repeat it whole.
    ends = small.unionByName(large).select(*_PLACE, F.explode("earlier" if keep == "first" else "any").alias("r"))
    copied = met.join(stage(classes.where("n > 1").select(*_CLASS, "first"), "copied"), list(_CLASS))
    if keep == "first":
        copied = copied.where(~place.eqNullSafe(F.col("first")))
    whole = F.struct(F.lit(0).alias("from"), (F.col("hi") - F.col("lo")).cast("int").alias("to"))
    spans = stage(ends, "ends").unionByName(copied.select(*_PLACE, whole.alias("r")))
    start, end = F.col("lo") + F.col("r.from"), F.col("lo") + F.col("r.to") + length
    return spans.select("d1", "d2", start.alias("start"), end.alias("end"))


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, keep: str = "first"
) -> DataFrame:
    """``(row, n_bytes, removed, kept)`` for every row of ``docs``.

    ``row`` holds all columns of ``docs``, ``removed`` the maximal removed runs as
    ``(start, end)`` byte offsets in order, ``kept`` the remaining bytes, joined: a
    cut may fall inside a character. Null and empty texts, and texts shorter
    than ``length``, lose nothing. With ``keep="first"``, rows equal in key and
    text count as one document; with ``keep="none"`` each is a copy of the other.
    """

    @F.arrow_udf("removed array<struct<start: long, end: long>>, kept binary")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        removed, kept = [], []
        for value, own in zip(texts, spans.to_pylist(), strict=True):
            body = value.as_py() or b""
            merged: list[list[int]] = []
            for span in sorted((s["start"], s["end"]) for s in own or ()):
                if merged and span[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span[1])
                else:
                    merged.append([*span])
            edges = [0, *(x for span in merged for x in span), len(body)]
            kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            removed.append([{"start": a, "end": b} for a, b in merged])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays([pa.array(removed, kind), pa.array(kept, pa.binary())], ["removed", "kept"])

    spans = repeated_spans(docs, key, text, length, keep)
    spans = spans.groupBy("d1", "d2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = docs.select(F.struct("*").alias("row"), *_identity(key, text)).join(spans, ["d1", "d2"], "left")
    joined = rows.withColumn("bytes", F.col("row")[text].cast("binary"))
    done = joined.select("row", F.coalesce(F.octet_length("bytes"), F.lit(0)).cast("long").alias("n_bytes"), cut("bytes", "spans").alias("cut"))
    return done.select("row", "n_bytes", "cut.removed", "cut.kept")
